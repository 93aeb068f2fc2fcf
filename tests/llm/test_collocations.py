import re
import sys
from collections import Counter, defaultdict

sys.path.insert(0, __file__.rsplit("/", 1)[0])
import numpy as np  # noqa: E402

from strata.llm import collocations as C  # noqa: E402


def brute(rows, top=2000):
    grams = defaultdict(Counter)
    for lang, text in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\x0A-\x0D]", low):
            words = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                grams[lang or "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in grams.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        longer = defaultdict(int)
        for g, c in f.items():
            if len(g) == 3 and c >= 10:
                for part in (g[:2], g[1:]):
                    longer[part] = max(longer[part], c)
        mine = []
        for g, a in f.items():
            if len(g) > 1 and a >= 10 and not (len(g) == 2 and g in longer and 100 * longer[g] >= 50 * a):
                score, k = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                mine.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, r, p.decode(), -a, l, rr, n, -s) for r, (s, a, p, l, rr) in enumerate(sorted(mine)[:top], 1)]
    return sorted(out)


def corpus():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(30)] + ["É", "#"]
    rows = []
    for i in range(400):
        text = " ".join(rng.choice(words, 25, p=(lambda s: s / s.sum())(1 / np.arange(1, 33))))
        rows.append((("en", "de", None)[i % 3], text[:60] + ("," if i % 2 else "\t ") + text[60:] + " New York City. new york"))
    return rows + [("en", None), ("xx", ""), ("fr", "a b " * 30), ("long", "x" * 300 + " y z; " + "x" * 300 + " y z. " * 12 + ("x" * 300 + " y ") * 12)]


def collected(df):
    return sorted(tuple(r) for r in df.collect())


def test_against_brute_force_with_few_wanted(spark, monkeypatch):
    """One round settles or several do; hashes sent or everything counted; slices of a few words."""
    rows = corpus()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert collected(C.mine(docs)) == brute(rows)
    monkeypatch.setattr(C, "SLACK", 1)
    monkeypatch.setattr(C, "SENT", 3)
    monkeypatch.setattr(C.slices, "__defaults__", (200,))
    assert collected(C.mine(docs, 5)) == brute(rows, 5)


def test_odd_tables(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert C.mine(none).collect() == [] and C.mine(spark.createDataFrame([("en", None), (None, "one")], "lang string, text string")).collect() == []
