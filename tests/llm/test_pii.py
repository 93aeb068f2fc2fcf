import hashlib
import sys

from hypothesis import given, settings, strategies as st

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from conftest import SF_SMALL  # noqa: E402
from llm_helpers import base_spans  # noqa: E402
from strata.llm import pii  # noqa: E402
from strata.llm.queries import op2_pii  # noqa: E402

HARD = [
    None, "", "a@b.c@d.e x@y %x@y.z.w\u0001 q\u0001@a.bc 1.2.3.4.5.6.7.8 0001.02.3.4 256.1.1.1",
    "9" * 30000 + " 4111 1111 1111 1111 " + "1 " * 20000, "a" * 100000 + "@" + "b." * 50000,
    "é😀 me@é.fr a@b.c-%x@d.e IBAN GB82 WEST 1234 5698 7654 32. tel +49 (0) 123-45678 )+1 555",
    "4111-1111-1111-1111 4111111111111112 +1 (017) 555-7713", "+1" + "." * 5000 + "2", "1.1.1.1" * 2000,
]


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["pii"]] for r in pii.find(df).collect()}


def test_base_kinds_as_brute_force_on_hard_texts(spark):
    got = found(spark, HARD)
    for i, text in enumerate(HARD):
        assert [s for s in got[i] if s[0] in pii.BASE] == base_spans(text)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="a1@.+- ()%é\u00014", max_size=60), min_size=40, max_size=40))
def test_base_kinds_as_brute_force_on_random_texts(spark, texts):
    got = found(spark, texts)
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[0] in pii.BASE] == base_spans(text)


def test_added_kinds_need_checksum_or_context(spark):
    key = "0123456789abcdef0123456789abcdef"
    got = found(spark, [f"token = \"{key}\"", f"colour {key}", "GB82 WEST 1234 5698 7654 32", "GB83 WEST 1234 5698 7654 32"])
    assert [[s[0] for s in got[i]] for i in range(4)] == [["secret"], [], ["iban"], []]


def test_query_over_the_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op2_pii(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base_spans(texts[r["doc_id"]])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in want) for k in pii.BASE]
        assert r["spans"].startswith(text)


def test_redaction_keeps_columns_nulls_and_the_rest_of_the_text(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "mail a@b.co or 1.2.3.4!", "z"), (3, "clean", "z")],
                               "doc_id long, text string, _pii string")
    got = [tuple(r) for r in pii.redact(df).orderBy("doc_id", "text").collect()]
    assert got == [(1, None, "x"), (2, "", "y"), (3, "clean", "z"), (3, "mail [EMAIL] or [IP]!", "z")]
    assert pii.redact(df.limit(0)).collect() == []


def test_ibans_before_and_after_capital_and_number_words(spark):
    de, short, gb = "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    texts = [f"{de} BIC COBADEFFXXX", f"{short} I said", f"{short} 2024 due", f"pay {de} 2024 TO {gb} NOW", f"REF AB12 {de}, é",
             f"{gb} {de}", f"AB12 {de} {gb} X1", f"{short}x {de}y", "AB12 " * 3000 + short, f"{short}\u0001 A", de + " 1" * 9]
    want = [[de], [short], [short], [de, gb], [de], [gb, de], [de, gb], [], [short], [short], [de]]
    got = found(spark, texts)
    for i, text in enumerate(texts):
        assert [text[a:b] for k, a, b in got[i] if k == "iban"] == want[i], text[:60]
    df = spark.createDataFrame([(1, texts[0])], "doc_id long, text string")
    assert "[IBAN] BIC COBADEFFXXX" == pii.redact(df).first()["text"]


def test_context_words_are_whole_words(spark):
    secret = "0123456789abcdef" * 2
    no = [f"monkey {secret}", f"tokenizer {secret}", f"keyé {secret}", secret, f"on{'x' * 60}key {secret}",
          f"mon key{'.' * 60}{secret}", f"{'a' * 30} {'mon'}key{' ' * 45}{secret}"]
    yes = [f"key {secret}", f"API_KEY={secret}", f"Tokens: {secret}", f"the apikey is {secret}", f"{'a' * 90} secret: {secret}"]
    got = found(spark, no + yes)
    assert [any(k == "secret" for k, _, _ in got[i]) for i in range(len(no + yes))] == [False] * len(no) + [True] * len(yes)
