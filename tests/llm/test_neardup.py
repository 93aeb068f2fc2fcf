import random
import sys

import numpy as np

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from conftest import SF_SMALL  # noqa: E402
from llm_helpers import near_components, shingle_set  # noqa: E402
from strata.llm import neardup  # noqa: E402
from strata.llm.components import components, roots  # noqa: E402
from strata.llm.queries import op3_minhash_neardup  # noqa: E402


def test_query_as_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = near_components(rows)
    got = op3_minhash_neardup(spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(shingle_set(t)) for i, t in rows}
    assert all(r["kept"] == (r["component_id"] == r["doc_id"]) for r in got)


def test_large_group_common_passage_and_odd_rows(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base, passage = [word() for _ in range(120)], [word() for _ in range(40)]
    rows = []
    for i in range(300):  # near copies with up to three edits: more than a small node or a block
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(120)] = word()
        rows.append((1000 + i, " ".join(text)))
    rows += [(5000 + i, " ".join([word() for _ in range(60)] + passage)) for i in range(150)]  # alike, never linked
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "One Two"), (5, "one\x0btwo"), (6, "one two three"), (7, "x " * 30000),
             (8, "X " * 20000), (9, "É a b c d"), (10, "é a b c d"), (11, " ".join(base)), (11, "one two")]
    df = spark.createDataFrame([*rows, (None, " ".join(base))], "doc_id long, text string")
    got = neardup.link(df).collect()
    want = near_components(rows)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want
    nameless = [r for r in got if r["doc_id"] is None]
    assert [(r["component_id"], r["kept"]) for r in nameless] == [(None, True)]
    kept = neardup.deduplicate(df.selectExpr("doc_id", "text", "1 as kept", "2 as component_id"))
    assert kept.columns == ["doc_id", "text", "kept", "component_id"]
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in set(ids) if i is not None) == sorted(i for i, c in want.items() if i == c)
    assert neardup.link(df.limit(0)).collect() == []


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(100, 200)] + [(7, j) for j in range(300, 400)] + [(5, 5), (400, 7), (9, 8), (8, 9)]
    got = {r["node"]: r["component"] for r in components(
        spark.createDataFrame(edges, "a long, b long").repartition(7), "a", "b").collect()}
    assert got == {**{i: 100 for i in range(100, 201)}, **{j: 7 for j in [7, *range(300, 401)]}, 8: 8, 9: 8}


def test_roots():
    assert roots(6, np.array([5, 4, 1]), np.array([4, 3, 0])).tolist() == [0, 0, 2, 3, 3, 3]


def test_blocks_lose_no_link():
    rng = np.random.default_rng(0)
    base = np.sort(rng.choice(10 ** 6, 200, replace=False).astype(np.uint64))
    sets = [np.unique(np.concatenate([base[: 200 - k], rng.choice(10 ** 6, k).astype(np.uint64)])) for k in rng.integers(0, 40, 30)]
    want = {(i, j) for i in range(30) for j in range(i + 1, 30)
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
    for split in (0, 10):
        a, b = neardup._forest(sets, split)
        assert set(zip(a, b)) <= want
        allowed = {(i, j) for i, j in want if not split or i < split <= j}
        full = roots(30, np.array([i for i, _ in allowed], int), np.array([j for _, j in allowed], int))
        assert roots(30, np.array(a, int), np.array(b, int)).tolist() == full.tolist()
