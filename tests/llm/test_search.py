import math
import re
import sys
from collections import Counter

sys.path.insert(0, __file__.rsplit("/", 1)[0])
import numpy as np  # noqa: E402

from strata.llm import search as S  # noqa: E402

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k=50):
    own = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n_docs, words = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    out = []
    for item, text in items:
        weight = {}
        for t in set(TERM.findall((text or "").translate(LOWER))):
            df = sum(t in c for _, c in own)
            weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        scores = []
        for i, c in own:
            m = 50 + 50 * sum(c.values()) * n_docs // words if words else 0
            score = sum(w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t, w in weight.items() if t in c)
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_random_documents_in_small_shards(spark, monkeypatch):
    """Ties across shards and tasks, several blocks of items, hot terms; rows as the sum over all terms gives them."""
    monkeypatch.setattr(S, "SHARD", 70)
    monkeypatch.setattr(S, "FIRST", 2)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "É", "x1"]
    share = 1 / np.arange(1, len(words) + 1)
    docs = [(i, " ".join(rng.choice(words, rng.integers(0, 30), p=share / share.sum()))) for i in range(700)]
    docs += [(700 + i, docs[5 * i][1].upper()) for i in range(100)] + [(None, "w1 w2"), (900, None), (901, "W1,w1;w2")]
    items = [(i, " ".join(rng.choice(words, 6))) for i in range(12)] + [(50, None), (51, "unknown"), (52, "w0 w0")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    it = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, S.rank(d, it, 20).collect())) == brute(docs, items, 20)
    monkeypatch.setattr(S.blocks, "__defaults__", (13,))
    assert sorted(map(tuple, S.rank(d, it, 20).collect())) == brute(docs, items, 20)


def test_odd_tables(spark):
    d = spark.createDataFrame([(1, "a b", 7)], "doc_id long, text string, score int")
    it = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a")], "item_id long, text string")
    assert [tuple(r) for r in S.rank(d, it).collect()] == brute([(1, "a b")], [(1, "a b")])
    assert S.rank(d.limit(0), it).collect() == [] and S.rank(d, it.limit(0)).collect() == []
    assert S.rank(d.withColumn("text", S.F.lit(None).cast("string")), it).collect() == []


def test_reads_stop_when_the_best_are_settled():
    """A document far ahead settles its list long before the end of it is read."""
    size = 100_000
    places, impacts = np.arange(size), np.sort(np.random.default_rng(0).integers(1, 1000, size))[::-1].astype(np.int64)
    impacts[0] = 10_000

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, key):
            if isinstance(key, slice):
                Counted.read = max(Counted.read, key.stop or 0)
            return super().__getitem__(key)

    found, scores = S.nra([(places.view(Counted), impacts)], size, 1)
    assert found.tolist() == [0] and scores.tolist() == [10_000] and Counted.read == S.FIRST
