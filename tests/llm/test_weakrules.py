import re
import sys
from collections import Counter

sys.path.insert(0, __file__.rsplit("/", 1)[0])
import numpy as np  # noqa: E402
from conftest import SF_ORACLE  # noqa: E402

from strata.llm import weakrules as W  # noqa: E402
from strata.llm.queries import op11_weak_rules  # noqa: E402

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def plain(text):
    """The contract's columns, straight from its words."""
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    found = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if found[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def slow_em(codes, rules):
    """EM over single documents, without numpy's shortcuts: P(good) of each."""
    docs = [[c // 3 ** k % 3 for k in range(rules)] for c in codes]
    good = [W.START[1] if W.BAD in d else W.START[0] for d in docs]
    n, before = len(docs), -np.inf
    for _ in range(W.ROUNDS):
        tables = []
        for label, own in (("bad", [1 - g for g in good]), ("good", good)):
            table = [[W.STRENGTH[label] * n * p for p in W.PRIOR[label]] for _ in range(rules)]
            for d, w in zip(docs, own):
                for k, v in enumerate(d):
                    table[k][v] += w
            tables.append([[x / sum(row) for x in row] for row in table])
        share = (sum(good) + n * W.STRENGTH["good"]) / (n * (1 + sum(W.STRENGTH.values())))
        ways = [[np.log(p) + sum(np.log(t[k][v]) for k, v in enumerate(d)) for t, p in zip(tables, (1 - share, share))] for d in docs]
        both = [np.logaddexp(*w) for w in ways]
        good = [float(np.exp(w[1] - b)) for w, b in zip(ways, both)]
        now = sum(both) + sum(W.STRENGTH[c] * n * p * np.log(t[k][v]) for c, t in zip(("bad", "good"), tables)
                              for k in range(rules) for v, p in enumerate(W.PRIOR[c]))
        if now - before < 1e-9 * n:
            break
        before = now
    return good


def test_whole_table_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    rows = op11_weak_rules(spark, SF_ORACLE).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in BASE) == plain(texts[r["doc_id"]])
        assert r["kept"] == (not r["base_failed"] and r["posterior"] >= W.KEEP_AT)
    votes = spark.createDataFrame(rows).select(*[W.vote(x).alias(x.name) for x in W.RULES], "posterior").collect()
    codes = [sum(v[k] * 3 ** k for k in range(len(W.RULES))) for v in votes]
    assert np.allclose([v["posterior"] for v in votes], slow_em(codes, len(W.RULES)), atol=1e-6)
    # what the labels say, which the operator has not seen
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    judged = [(quality[r["doc_id"]], r["kept"]) for r in rows if r["doc_id"] in quality and not r["base_failed"]]
    assert np.mean([k for q, k in judged if q == 1]) > 0.98 and np.mean([k for q, k in judged if q == 0]) < 0.05


def test_odd_rows(spark):
    long = "alpha beta gamma. " * 200_000
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "\n \t\n", 5), (3, "\n \t\n", 5), (None, "#" * 3, 5), (4, long, 5)],
                                 "doc_id long, text string, kept int")
    got = {r["doc_id"]: r for r in W.judge(docs).collect()}
    assert len(got) == 5 and got[4]["n_words"] == 600_000 and got[4]["n_repeat_words"] == 600_000 and not got[4]["kept"]
    assert got[None]["n_symbols"] == 3 and got[1]["text"] is None and all(r["base_failed"] for r in got.values())
    assert W.judge(docs.limit(0)).collect() == [] and W.judge(docs).count() == 6


def test_accuracies_are_found_from_votes_alone():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.9, 0.85])
    votes = np.where(rng.random((20_000, 6)) < right, truth[:, None], ~truth[:, None])
    patterns, counts = np.unique(np.where(rng.random((20_000, 6)) < 0.2, W.ABSTAIN, np.where(votes, W.GOOD, W.BAD)), axis=0, return_counts=True)
    model = W.fit(patterns, counts.astype(float))
    assert np.abs(model.accuracy() - right).max() < 0.05 and abs(model.share_good - 0.8) < 0.05
