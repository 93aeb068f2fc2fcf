"""Byte-pair encoding of distinct words over a trie, and decoding.

Two adjacent tokens are *compatible* if encoding their joined bytes gives just
these two. The encoding of a prefix ends in exactly one token, and a token ends
the encoding of a longer prefix if it is compatible with the last token of what
comes before it. So one number per prefix, its last token, holds its whole
encoding. Distinct words are put in a trie (here: sorted, so that a word shares
its first letters with the one before) and walked depth first: the last tokens
of a shared prefix are computed once for all the words below it.

A text is cut into units (see ``units``) and those into words by the
tokenizer's pattern; only words that a worker has not met lately are walked.

Defined results: a null text counts as empty; an empty text has no ids and
decodes to the empty text; the text of the special token is that token, as the
library has it; bytes that are not UTF-8 decode to replacement characters.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import prepare
from strata.llm.units import WORDS, UnitEncoder, byte_letters, id_bytes


class TrieBPE:
    """Encoder and decoder for a byte-level BPE vocabulary in the tokenizers library's file format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of_letter = {c: b for b, c in byte_letters().items()}
        raw = lambda token: bytes(of_letter[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.ids = {raw(token): i for token, i in vocab.items()}
        self.longest = max(map(len, self.ids))
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.merged: dict = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            first, second = pair if isinstance(pair, list) else pair.split(" ")
            a, b, t = vocab[first], vocab[second], vocab[first + second]
            self.merged[a, b] = (rank, t)
            if self.rank[t] < 0:
                self.rank[t], self.left[t], self.right[t] = rank, a, b
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = [b""] * size
        for token, i in self.ids.items():
            self.bytes[i] = token
        for content, i in self.special.items():
            self.bytes[i] = content.encode()
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.cut_words = regex.compile(WORDS)
        self.compatible: dict = {}
        self.checked = bytearray(size)  # 0: not yet, 1: a token's bytes encode to it, 2: they do not
        self.packed = [i.to_bytes(4, "little") for i in range(size)]

    def _survives(self, a: int, b: int) -> bool:
        """Whether no merge across the boundary comes before those that made the tokens.

        The later of the two tokens is taken apart until both are single bytes; a pair at the
        boundary that merges earlier than the last one undone would have merged across it.
        """
        limit = len(self.merged)
        rank, merged = self.rank, self.merged
        while True:
            across = merged.get((a, b))
            if across is not None and across[0] < limit:
                return False
            if rank[a] > rank[b]:
                limit, a = rank[a], self.right[a]
            elif rank[b] >= 0:
                # of equal merges the left one comes first, so an equal one across would have won
                limit, b = rank[b] + 1, self.left[b]
            else:
                return True

    def _stable(self, token: int) -> bool:
        """Whether a token's own bytes encode to it: the merges in their order, one by one."""
        parts = [self.ids[bytes([x])] for x in self.bytes[token]]
        while len(parts) > 1:
            best = min(((self.merged[p][0], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.merged), default=None)
            if best is None:
                break
            i = best[1]
            parts[i:i + 2] = [self.merged[parts[i], parts[i + 1]][1]]
        return parts == [token]

    def encode_words(self, words: list) -> dict:
        """ids (uint32 bytes) of each distinct word (bytes).

        ``last`` and ``ids`` hold, for each prefix of the word at hand, its last token and its
        whole encoding; what it shares with the word before stays.
        """
        out = {}
        vocabulary, checked, compatible = self.ids, self.checked, self.compatible
        longest, packed = self.longest, self.packed
        if len(compatible) > 500_000:
            compatible.clear()
        before, last, ids = b"", [-1], [b""]
        for word in sorted(words):
            n, depth = len(word), 0
            most = min(n, len(before))
            while depth < most and word[depth] == before[depth]:
                depth += 1
            del last[depth + 1:], ids[depth + 1:]
            for end in range(depth + 1, n + 1):
                for start in range(end - longest if end > longest else 0, end):
                    token = vocabulary.get(word[start:end])
                    if token is None:
                        continue
                    if checked[token] != 1:
                        if not checked[token]:
                            checked[token] = 1 if self._stable(token) else 2
                        if checked[token] == 2:
                            continue
                    if start:
                        pair = (last[start], token)
                        fits = compatible.get(pair)
                        if fits is None:
                            fits = compatible[pair] = self._survives(*pair)
                        if not fits:
                            continue
                    last.append(token)
                    ids.append(ids[start] + packed[token])
                    break
            out[word] = ids[n]
            before = word
        return out

    def _cut(self, part: str) -> list:
        """Words of a text as bytes; letters after one space are one word without asking the pattern."""
        if part[:1] == " " and part[1:].isalpha() and max(part) < "\u0250":
            return [part.encode()]
        return [w.encode("utf-8", "replace") for w in self.cut_words.findall(part)]

    def encode_units(self, units: list) -> list:
        """ids (uint32 bytes) of each unit."""
        cut = []
        for unit in units:
            if self.cut_special and "<" in unit:
                cut.append([p if p in self.special else self._cut(p) for p in self.cut_special.split(unit) if p])
            else:
                cut.append([self._cut(unit)])
        known = self.encode_words({w for parts in cut for p in parts if isinstance(p, list) for w in p})
        return [b"".join([self.packed[self.special[p]] if isinstance(p, str) else b"".join(map(known.__getitem__, p))
                          for p in parts]) for parts in cut]

    def decode(self, ids: list) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict = {}


def loaded(path: str) -> tuple:
    """(TrieBPE, its UnitEncoder), one of each for a worker process and file."""
    if path not in _LOADED:
        bpe = TrieBPE(path)
        _LOADED[path] = bpe, UnitEncoder(bpe.encode_units)
    return _LOADED[path]


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = loaded(path)
        for batch in batches:
            counts, digests, decoded = [], [], []
            for raw in id_bytes(encoder, batch.column("text")):
                ids = np.frombuffer(raw, "<u4")
                counts.append(len(ids))
                digests.append(hashlib.sha256(raw).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids.tolist()).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, out: str = "ids") -> DataFrame:
    """All rows with the ids of ``text`` added as ``out``, an array of integers (replacing that name)."""
    prepare(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        _, encoder = loaded(path)
        for some in texts:
            yield pd.Series([np.frombuffer(x, "<u4").astype("int32") for x in id_bytes(encoder, pa.array(some, pa.string()))],
                            dtype=object)

    return docs.withColumn(out, run("text"))
