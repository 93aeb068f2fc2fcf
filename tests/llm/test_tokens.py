"""Token files, trie encoding and packing, held against the tokenizers library."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strata.llm import packing, tokenfile, triebpe, units
from strata.llm.queries import tokenizer

PATH = tokenizer()
LIBRARY = Tokenizer.from_file(PATH)
ROWS = [(None, "null id"), (1, None), (2, ""), (3, "a<|endoftext|>b  c\n\n d" * 4000), (4, "again"), (4, "again"), (4, "other"),
        (5, "word " * 1023), (6, "x" * 30000), (7, "\x85 é日本 　　a  ")]


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(numbers):
    return zlib.crc32(np.array(numbers, "<u4").tobytes())


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id + 100 as doc_id", "text")
    return base.unionAll(spark.createDataFrame(ROWS, "doc_id long, text string")).repartition(5).cache()


def test_units_and_trie_as_the_library():
    rng = random.Random(5)
    letters = [*"abc ABC  \n\t\r012 .,!?'\"-_<|>é日😀\x85\xa0 　\x1c​\x00ñª²Ⅷ", "'s", " the", "ing", "<|endoftext|>", "   "]
    bpe, walked = triebpe.loaded(PATH)
    looked = units.library_encoder(PATH)
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        want = np.array(ids(text), "<u4").tobytes()
        assert walked([text]) == [want] == looked([text])
    for _ in range(200):
        some = [rng.randrange(50257) for _ in range(30)]
        assert bpe.decode(some) == LIBRARY.decode(some, skip_special_tokens=False)


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(units, "CACHED", 20)
    monkeypatch.setattr(units, "LONGEST", 6)
    encoder = units.UnitEncoder(lambda us: [np.array(ids(u), "<u4").tobytes() for u in us])
    rng = random.Random(1)
    for _ in range(60):
        texts = [" ".join(rng.choice(["a", "bb", "longerword", "c,", "x\n", ""]) + str(rng.randrange(9)) for _ in range(12)) for _ in range(3)]
        assert encoder(texts) == [np.array(ids(t), "<u4").tobytes() for t in texts]


def test_line_ends_and_tails_make_no_new_units():
    asked = []
    encoder = units.UnitEncoder(lambda us: asked.extend(us) or [np.array(ids(u), "<u4").tobytes() for u in us])
    rng = random.Random(2)
    texts = ["".join(rng.choice(["on", "to", "we"]) + rng.choice([" ", ", ", ".\n", "!?\n\n", "\t"]) for _ in range(200)) for _ in range(20)]
    assert encoder(texts) == [np.array(ids(t), "<u4").tobytes() for t in texts]
    assert len(asked) == len(set(asked)) and not any("\n" in u[1:].lstrip("\n") or u != "," and u.endswith(",") for u in asked)


def test_texts_a_few_at_a_time():
    column = pa.array([None, "", "a b", "long, " * 50, None, "a b\nc"])
    for batch, held in ((1, 1 << 20), (4, 1), (256, 1 << 20)):
        got = list(units.id_bytes(units.library_encoder(PATH), column, batch, held))
        assert got == [np.array(ids(t), "<u4").tobytes() for t in column.to_pylist()]


def test_trie_round_trip(docs):
    want = sorted((r["doc_id"] or -1, len(n := ids(r["text"])), hashlib.sha256(np.array(n, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256(LIBRARY.decode(n, skip_special_tokens=False).encode()).hexdigest()) for r in docs.collect())
    got = triebpe.round_trip(docs, PATH).collect()
    assert sorted((r["doc_id"] or -1, *r[1:]) for r in got) == want
    assert triebpe.round_trip(docs.limit(0), PATH).collect() == []
    kept = triebpe.encode(docs.selectExpr("doc_id", "text", "1 as _x"), PATH, "ids")
    assert kept.columns == ["doc_id", "text", "_x", "ids"]
    assert all(r["ids"] == ids(r["text"]) for r in kept.limit(20).collect())


def test_ranks_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 1001):
        ranks = rng.choice([0, 255, 256, 65535, 65536, 2 ** 24 - 1, 2 ** 24, 2 ** 32 - 1], n).astype(np.uint32)
        assert (tokenfile.decode_ranks(*tokenfile.encode_ranks(ranks), n) == ranks).all()


def test_token_files(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK", 3000)
    monkeypatch.setattr(tokenfile, "BLOCKS_A_FILE", 2)
    rows = sorted(((r["doc_id"], ids(r["text"]) + [0]) for r in docs.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, crc(r[1])))
    want, at = [], 0
    for doc, numbers in rows:
        want.append((doc, at, len(numbers), crc(numbers), numbers))
        at += len(numbers)
    tokenfile.write(docs, PATH, f"{tmp_path}/c")
    got = sorted((tuple(r) for r in tokenfile.read(spark, f"{tmp_path}/c").collect()), key=lambda r: r[1])
    assert got == want
    ranks = spark.read.parquet(f"{tmp_path}/c/ranks").orderBy("rank").collect()
    assert [r["occurrences"] for r in ranks] == sorted((r["occurrences"] for r in ranks), reverse=True)
    assert sum(r["occurrences"] for r in ranks) == at
    assert tokenfile.encode_and_read(docs.limit(0), PATH).collect() == []


def test_packing(docs):
    texts = sorted(((r["doc_id"] or -1, ids(r["text"]) + [0]) for r in docs.collect()), key=str)
    got = packing.pack(docs, PATH).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"] or -1].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for doc, numbers in texts:
        want[doc] += [(s, len(numbers[s:s + 1024]), crc(numbers[s:s + 1024]), len(numbers)) for s in range(0, len(numbers), 1024)]
    assert {d: sorted(p) for d, p in by_doc.items()} == {d: sorted(p) for d, p in want.items()}
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert sum(len(n) for _, n in texts) > 0.9 * 1024 * len(by_sequence)
    assert packing.pack(docs.limit(0), PATH).collect() == []


def test_packed_sequences_hold_the_ids(docs, monkeypatch):
    monkeypatch.setattr(packing, "FLUSH", 3000)
    by_doc, sizes = defaultdict(list), defaultdict(int)
    for r in packing.pack(docs.where("doc_id <> 4"), PATH).collect():
        held = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(held) == r["length"] and crc(held) == r["ids_crc32"]
        by_doc[r["doc_id"]].append((r["start"], held))
        sizes[r["sequence_id"]] += len(held)
    assert max(sizes.values()) <= 1024
    assert {d: sum((h for _, h in sorted(p)), []) for d, p in by_doc.items()} == {
        r["doc_id"]: ids(r["text"]) + [0] for r in docs.where("doc_id <> 4").collect()}


@pytest.mark.parametrize("seed, n, padding", [(1, 20000, 0.02), (2, 50, 0.2), (3, 1, 1e9)])
def test_plan_uses_every_piece_once(seed, n, padding):
    histogram = np.bincount(np.random.default_rng(seed).integers(1, 1024, n), minlength=1025)
    patterns = packing.plan(histogram)
    used = np.zeros(1025, np.int64)
    for lengths, copies in patterns:
        assert sum(lengths) <= 1024
        np.add.at(used, list(lengths), copies)
    assert (used == histogram).all()
    tokens = int((histogram * np.arange(1025)).sum())
    assert 1024 * sum(c for _, c in patterns) <= tokens * (1 + padding)
