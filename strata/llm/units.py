"""Encoding texts by their units: runs of white space with the word that follows.

Byte-level BPE never merges across the start of a white-space run, and the
pattern that cuts a text before the merges looks no further back than the run,
so a text's ids are the ids of its units, one after the other. A unit that
occurred before is a dictionary look-up. Punctuation that ends a unit after a
letter or digit is a piece of its own for the pattern, so it is cut off and
counts as a unit. The units of some texts are told apart by Arrow, so that each
distinct one is looked up once. What is new is cut
by the pattern and goes to the library's BPE model piece by piece; units with
characters beyond Latin or with a special token go through its whole encoder.
The dictionaries are bounded in bytes and forgotten when full, which changes
the time, not the result.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# The white space of the pre-tokenizer's pattern (fixed values: Unicode's White_Space property).
WHITE = "\t-\r \x85\xa0  -     　"
_RUNS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_WHITES = re.compile(f"[{WHITE}]+")
_BREAKS = [c for c in map(chr, range(0x3001)) if _WHITES.match(c) and c != " "]
# The pattern of byte-level tokenizers, with the white space spelled out.
WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^{W}\p{L}\p{N}]+|[{W}]+(?![^{W}])|[{W}]+").replace("{W}", WHITE)
_LATIN = re.compile("[ -~\n\u00a1-\u024f]+").fullmatch
# Bytes of one generation of a dictionary; what an entry takes beside its text and ids.
CACHED = 80 << 20
ENTRY = 200
LONGEST = 64
# Where a tail can be cut off a unit: these marks (no apostrophe, none of a special token) after a Latin letter or a digit.
TAIL = ".,;:!?&#$%*)"
_ENDS = frozenset("0123456789" + "".join(c for c in map(chr, range(0x250)) if c.isalpha()))


# A tail: only its first mark is looked at from behind, so that few places of a text are.
_TAILS = re.compile(f"[{TAIL}](?<=[{''.join(sorted(_ENDS))}][{TAIL}])[{TAIL}]*(?=\0|\\Z)")
MARK = "\0"


def _marked(text: str) -> str:
    """The text, which has no mark, with one before each unit and each tail."""
    breaks = [c for c in _BREAKS if c in text]
    if "  " in text or breaks and (breaks != ["\n"] or "\n\n" in text or " \n" in text or "\n " in text):
        text = _WHITES.sub(MARK + r"\g<0>", text)
    else:
        text = text.replace(" ", MARK + " ").replace("\n", MARK + "\n")
    return _TAILS.sub(MARK + r"\g<0>", text)


class _Known:
    """What is known of units, in two generations.

    Units in use are in the young one; when that is full, it becomes the old one, from which
    units still in use are taken over. So the frequent stay and memory is bounded.
    """

    def __init__(self) -> None:
        self.young: dict = {}
        self.old: dict = {}
        self.long: list = []
        self.held = 0

    def missing(self, used: Iterable) -> list:
        """Units of ``used`` (distinct) that have to be encoded; those of the old generation are taken over."""
        new = list(filterfalse(self.young.__contains__, used))
        kept = list(filter(self.old.__contains__, new))
        if kept:
            self._hold(kept, list(map(self.old.__getitem__, kept)))
            new = list(filterfalse(self.old.__contains__, new))
        return new

    def ids(self, units: list, encode: Callable[[list], list]) -> list:
        """The ids of distinct units, new ones by ``encode``."""
        found = list(map(self.young.get, units))
        new = [k for k, ids in enumerate(found) if ids is None]
        if new:
            wanted = [units[k] for k in new]
            unknown = self.missing(wanted)
            if unknown:
                self._hold(unknown, encode(unknown))
            for k, unit in zip(new, wanted):
                found[k] = self.young[unit]
        self.settle()
        return found

    def _hold(self, units: list, ids: list) -> None:
        self.young.update(zip(units, ids))
        self.held += ENTRY * len(units) + sum(map(len, units)) + sum(map(len, ids))
        self.long += [u for u in units if len(u) > LONGEST]

    def settle(self) -> None:
        """Forget what is long; change generations when the young one is full."""
        for unit in self.long:
            ids = self.young.pop(unit, None)
            if ids is not None:
                self.held -= ENTRY + len(unit) + len(ids)
        self.long = []
        if self.held > CACHED:
            self.old, self.young, self.held = self.young, {}, 0


class UnitEncoder:
    """Texts to ids as little-endian uint32 bytes. ``encode`` does so for a list of distinct units."""

    def __init__(self, encode: Callable[[list], list]):
        self.encode = encode
        self.known = _Known()

    def __call__(self, texts: list) -> list:
        out, plain = [b""] * len(texts), []
        for i, text in enumerate(texts):
            if MARK in text:
                units = _RUNS.findall(text)
                distinct = list(set(units))
                of_unit = dict(zip(distinct, self.known.ids(distinct, self.encode)))
                out[i] = b"".join(map(of_unit.__getitem__, units))
            else:
                plain.append(i)
        if plain:
            for i, ids in zip(plain, self._units([_marked(texts[i]) for i in plain])):
                out[i] = ids
        return out

    def _units(self, marked: list) -> Iterator[bytes]:
        """The ids of marked texts; each distinct unit of all of them is looked up once."""
        units = pc.split_pattern(pa.array(marked, pa.large_string()), MARK)
        coded = units.flatten().dictionary_encode()
        known = self.known.ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.encode)
        _, offsets, data = pa.array(known, pa.large_binary()).take(coded.indices).buffers()
        ends = np.frombuffer(offsets, np.int64)[units.offsets.to_numpy()].tolist()
        for begin, end in zip(ends, ends[1:]):
            yield data[begin:end].to_pybytes() if end > begin else b""


def byte_letters() -> dict:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def piecewise(tokenizer) -> Callable[[list], list]:
    """Units to their ids as bytes by a byte-level tokenizer of the library."""
    whole = lambda units: [np.array(e.ids, "<u4").tobytes()
                           for e in tokenizer.encode_batch_fast(units, add_special_tokens=False)]
    shape = json.loads(tokenizer.to_str())
    cutter = shape["pre_tokenizer"] or {}
    if (cutter.get("type"), cutter.get("add_prefix_space"), cutter.get("use_regex")) != ("ByteLevel", False, True) or shape["normalizer"]:
        return whole
    special = regex.compile("|".join(regex.escape(t["content"]) for t in shape["added_tokens"]) or "(?!)")
    # whether a special token can be part of plain letters
    lettered = any(t["content"].strip(" ").isalpha() or not t["content"].strip(" ") for t in shape["added_tokens"])
    model, letters, cut = tokenizer.model, byte_letters(), regex.compile(WORDS)
    space = letters[32]

    tokenize, packed = model.tokenize, {}

    def ids_of(piece: str) -> bytes:
        """``piece`` in byte letters; ids that occurred before share their bytes."""
        ids = [t.id for t in tokenize(piece)]
        try:
            return packed[ids[0]] if len(ids) == 1 else b"".join([packed[i] for i in ids])
        except KeyError:
            packed.update((i, i.to_bytes(4, "little")) for i in ids)
            return b"".join([packed[i] for i in ids])

    def of_piece(piece: str) -> bytes:
        return ids_of(piece.encode().decode("latin-1").translate(letters))

    def encode(units: list) -> list:
        out, rest = [], []
        for unit in units:
            word = unit[1:] if unit[:1] == " " else unit
            if word.isalpha() and word.isascii() and not lettered:
                # its bytes are letters that stand for themselves
                out.append(ids_of(unit if word is unit else space + word))
                continue
            latin = _LATIN(unit) and not special.search(unit)
            if latin and word.isalpha():
                out.append(of_piece(unit))
            elif latin:
                out.append(b"".join(map(of_piece, cut.findall(unit))))
            else:
                rest.append(len(out))
                out.append(unit)
        for k in range(0, len(rest), 1024):
            some = rest[k:k + 1024]
            for i, ids in zip(some, whole([out[i] for i in some])):
                out[i] = ids
        return out

    return encode


_LOADED: dict = {}


def library_encoder(path: str) -> UnitEncoder:
    """Units encoded by the tokenizers library; one encoder for each worker process and file."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _LOADED[path] = UnitEncoder(piecewise(tokenizer))
    return _LOADED[path]


def id_bytes(encoder: UnitEncoder, column, batch: int = 256, held: int = 4 << 20):
    """The ids of each text of an Arrow column (null: empty), as bytes, some texts of ``held`` bytes at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(column):
        before = int(ends[at - 1]) if at else 0
        end = min(at + batch, max(at + 1, int(np.searchsorted(ends, before + held, side="right"))))
        yield from encoder([t or "" for t in column.slice(at, end - at).to_pylist()])
        at = end
