import sys
from collections import defaultdict

import numpy as np
import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from conftest import SF_SMALL  # noqa: E402
from llm_helpers import Union, vector_links  # noqa: E402
from strata.llm import pq  # noqa: E402
from strata.llm.components import roots  # noqa: E402
from strata.llm.queries import op8_pq_neardup  # noqa: E402


def held(got, rows, d):
    links, comp = vector_links(rows, d)
    have, want = defaultdict(list), defaultdict(list)
    for r in got:
        have[r["vec_id"]].append(r["n_links"])
    for i, n in links:
        want[i].append(n)
    for i in want:
        assert sorted(x for x in have[i])[-len(want[i]):] == sorted(want[i])
    assert {r["vec_id"]: r["component_id"] for r in got if r["vec_id"] in comp} == comp
    for r in got:
        if r["vec_id"] is not None and r["vec_id"] not in comp:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, r["vec_id"], True)


def test_query_as_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = op8_pq_neardup(spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    held(got, rows, len(rows[0][1]))


@pytest.mark.parametrize("small", [False, True])
def test_groups_copies_and_odd_vectors(spark, monkeypatch, small):
    if small:  # many lists, blocks and chunks
        monkeypatch.setattr(pq, "LIST_SIZE", 60)
        monkeypatch.setattr(pq, "BLOCK", 40)
        monkeypatch.setattr(pq, "CHUNK", 50)
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(40, 16))
    x = np.concatenate([centers[k % 40] + rng.normal(size=16) * 0.12 for k in range(600)]).reshape(600, 16).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, x[5].tolist()) for i in range(30)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [None] * 16), (2004, [float("nan")] * 16), (2005, [1.0, 2.0]),
             (2006, [float("inf")] + [1.0] * 15), (2007, [3 * c for c in x[9].tolist()]), (None, x[1].tolist()), (3, x[50].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = pq.link(df.selectExpr("*", "1 as n_links", "2 as rep")).collect()
    links, _ = vector_links(rows, 16)
    want, have = sum(n for _, n in links), sum(r["n_links"] for r in got)
    assert have == want
    held(got, rows, 16)
    assert len(got) == len(rows)
    assert pq.link(df.limit(0)).collect() == []


def test_vectors_of_each_length_link_among_themselves(spark):
    rng = np.random.default_rng(6)
    long = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(6, 8)).repeat(3, axis=0) + rng.normal(size=(18, 8)) * 0.05)]
    short = [(100, [1.0, 2.0]), (101, [1.0, 2.0]), (102, [1.1, 2.0]), (103, [-2.0, 1.0])]
    one = [(200, [3.0]), (201, [5.0]), (202, [-1.0])]
    alone = [(300, [1.0, 2.0, 3.0])]
    got = pq.link(spark.createDataFrame(long + short + one + alone, "vec_id long, embedding array<double>")).collect()
    want = {}
    for rows in (long, short, one, alone):
        links, component = vector_links(rows, len(rows[0][1]))
        want.update({i: (n, component[i], component[i] == i) for i, n in links})
    assert [want[i][0] for i in (100, 101, 103, 200, 201, 202)] == [2, 2, 0, 1, 1, 0]
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == want


def test_looked_up_distance_errs_by_at_most_the_stored_error():
    rng = np.random.default_rng(1)
    x = pq._unit(rng.normal(size=(300, 20)))
    model = pq.fit(x, 5)
    own, probed = model.lists(x)
    codes, errors = model.encode(x, own)
    for cell in range(5):
        inside = np.flatnonzero(own == cell)
        looked = model.lookup(x, cell, codes[inside])
        true = np.sqrt(((x[:, None] - x[None, inside]) ** 2).sum(-1))
        assert (np.abs(looked - true) <= errors[inside][None, :] + 1e-9).all()
    assert not probed[np.arange(300), own].any()


def test_every_link_across_many_lists_where_vectors_are_not_isotropic(spark, monkeypatch):
    monkeypatch.setattr(pq, "LIST_SIZE", 50)
    rng = np.random.default_rng(8)
    spectrum = np.arange(1, 65) ** -1.5
    x = pq._unit(rng.normal(size=(1000, 64)) * spectrum)
    offset = rng.normal(size=(1000, 64)) * spectrum
    offset -= (offset * x).sum(axis=1, keepdims=True) * x
    y = pq._unit(x + 0.32 * pq._unit(offset))  # planted pairs at a cosine of 0.952
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))]
    want = vector_links(rows, 64)[0]
    assert sum(n for _, n in want) >= 2000
    got = pq.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r["vec_id"], r["n_links"]) for r in got) == sorted(want)
    held(got, rows, 64)


def test_roots_as_one_by_one():
    rng = np.random.default_rng(3)
    for n in (1, 2, 40, 400):
        for _ in range(50):
            a, b = rng.integers(0, n, (2, n))
            union = Union(range(n))
            for pair in zip(a.tolist(), b.tolist()):
                union.join(*pair)
            assert roots(n, a, b).tolist() == [union.find(k) for k in range(n)]
