import hashlib
import random

from conftest import SF_SMALL
from hypothesis import given, strategies as st

from strata.llm import fingerprint as fp
from strata.llm.queries import op5_prefix_fingerprints

TEXT = st.text(alphabet="ab é😀", max_size=40)


@given(TEXT, TEXT, st.integers(0, 40), st.integers(0, 40))
def test_common_extension(a, b, i, j):
    i, j = min(i, len(a)), min(j, len(b))
    k = 0
    while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
        k += 1
    assert fp.PrefixHash(a).common_extension(i, fp.PrefixHash(b), j) == k


@given(TEXT, TEXT)
def test_edited_fingerprint_is_that_of_the_edited_text(a, b):
    text, edited = fp._Document(1, a).edited(fp._Document(2, b))
    n = len(a)
    assert text == a[:n - n // 3] + b[:n // 3]
    assert str(edited) == fp.fingerprint(text) == str(fp.Fingerprint.parse(fp.fingerprint(text)))


def expected(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for k, (doc, text) in enumerate(rows):
        after, n = rows[(k + 1) % len(rows)][1], len(text)
        edited = text[:n - n // 3] + after[:n // 3]
        prints = [fp.Fingerprint.parse(fp.fingerprint(t)) for t in (text, edited, after)]
        out.append((doc, n, hashlib.sha256(edited.encode()).hexdigest(), str(prints[0]), str(prints[1]),
                    prints[0].likeness(prints[1]), prints[0].likeness(prints[2])))
    return sorted(out, key=str)


def test_query_as_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = op5_prefix_fingerprints(spark, SF_SMALL).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)
    assert sum(r["near_edited"] for r in got) > 20 * sum(r["near_next"] for r in got)


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(None, "null id"), (None, None), (3, None), (4, ""), (5, "again"), (5, "again"), (5, "other"), (2 ** 60, "x" * 200000),
            *[(i, "".join(rng.choice("abc") for _ in range(rng.randrange(30)))) for i in range(10, 60)]]
    for some in (rows, rows[:1], rows[3:4], rows[-2:]):
        df = spark.createDataFrame(some, "doc_id long, text string").selectExpr("doc_id", "text", "1 as bucket", "2 as ahead")
        assert sorted(map(tuple, fp.neighbours(df.repartition(3)).collect()), key=str) == expected(some)
    assert fp.neighbours(spark.createDataFrame([], "doc_id long, text string")).collect() == []
