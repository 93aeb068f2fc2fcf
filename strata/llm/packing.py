"""Packing documents into sequences of ``WINDOW`` tokens by non-negative least squares.

1. *Pieces*: in tasks, every document is encoded, closed with the end id, and
   cut into whole windows and one remainder; each piece is numbered within its
   task among the pieces of its length.
2. *Histogram*: pieces by length, at most ``WINDOW`` numbers, to the driver.
3. *Patterns*: combinations of two, three or four lengths that fill a window
   exactly. Repeat counts are solved by non-negative least squares against the
   histogram (columns enter by their gradient, coordinate descent on those in
   use), rounded down, and what is left is packed greedily, largest first,
   pattern by pattern: a pattern is repeated until one of its lengths runs out.
4. *Places*: a piece's number among all pieces of its length (its task's offset
   plus its number there) says which copy of which pattern it fills. Counts by
   (task, length) and their running sums are tables, not driver lists.

The driver holds the histogram and the patterns, both bounded by ``WINDOW``,
never a document or a piece. The ids themselves go along as little-endian
uint32 bytes; the checksum is taken of what arrives in the sequences.

Defined results: a null or empty text is one piece of one token, the end id;
rows are packed one by one, also when they repeat a doc_id or have none; an
empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import prepare, written
from strata.llm.units import id_bytes, library_encoder

WINDOW = 1024
END = 0
FLUSH = 4 << 20


def pieces(docs: DataFrame, path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, task, number) of every piece."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, task = library_encoder(path), TaskContext.get().partitionId()
        close = np.array([end], "<u4").tobytes()
        seen = [0] * (window + 1)
        for batch in batches:
            rows, starts, lengths, ids, totals, numbers = [], [], [], [], [], []

            def cut() -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()), pa.array(totals, pa.int64()),
                     pa.array([task] * len(rows), pa.int32()), pa.array(numbers, pa.int64())],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "task", "number"])
                for column in (rows, starts, lengths, ids, totals, numbers):
                    column.clear()
                return out

            held = 0
            for i, raw in enumerate(id_bytes(encoder, batch.column("text"))):
                raw += close
                total = len(raw) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    rows.append(i)
                    starts.append(start)
                    lengths.append(length)
                    ids.append(raw[4 * start:4 * (start + length)])
                    totals.append(total)
                    numbers.append(seen[length])
                    seen[length] += 1
                held += len(raw)
                if held > FLUSH:
                    yield cut()
                    held = 0
            yield cut()

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, task int, number long")


def _triples(lengths: np.ndarray, window: int) -> np.ndarray:
    """All a <= b <= c of the given lengths that fill the window, as rows (a, b, c)."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    a, b = np.meshgrid(lengths, lengths, indexing="ij")
    c = window - a - b
    good = (a <= b) & (b <= c)
    good[good] = have[c[good]]
    return np.stack([a[good], b[good], c[good]], axis=1)


def _pairs(lengths: np.ndarray, window: int) -> np.ndarray:
    a = lengths[(2 * lengths <= window) & np.isin(window - lengths, lengths)]
    return np.stack([a, window - a], axis=1)


def _quads(residual: np.ndarray, lengths: np.ndarray, window: int) -> np.ndarray:
    """For every way to split the window in two sums, the two most wanted lengths of either sum."""
    a, b = np.meshgrid(lengths, lengths, indexing="ij")
    keep = (a <= b) & (a + b < window)
    a, b = a[keep], b[keep]
    order = np.lexsort((-(residual[a] + residual[b]), a + b))
    a, b = a[order], b[order]
    sums, first = np.unique(a + b, return_index=True)
    best = dict(zip(sums.tolist(), zip(a[first].tolist(), b[first].tolist())))
    rows = [sorted(best[s] + best[window - s]) for s in best if 2 * s <= window and window - s in best]
    return np.array(rows, np.int64).reshape(-1, 4)


def solve(histogram: np.ndarray, window: int = WINDOW, rounds: int = 24) -> tuple:
    """(patterns, repeats): how often each combination of lengths would best be used, as real numbers.

    ``histogram[n]``: pieces of length n, for n below the window.
    """
    lengths = np.flatnonzero(histogram)
    target = histogram.astype(float)
    residual = target.copy()
    fixed = [tuple(r) for r in _pairs(lengths, window)] + [tuple(r) for r in _triples(lengths, window)]
    by_size = {k: np.array([f for f in fixed if len(f) == k], np.int64).reshape(-1, k) for k in (2, 3)}
    active: dict = {}
    for _ in range(rounds):
        entering = []
        for k, rows in (*by_size.items(), (4, _quads(residual, lengths, window))):
            gain = residual[rows].sum(axis=1) / np.sqrt(k)
            top = np.argsort(-gain, kind="stable")[:96]
            entering += [(gain[i], tuple(rows[i].tolist())) for i in top if gain[i] > 0.25]
        before = len(active)
        for _, pattern in sorted(entering, reverse=True)[:192]:
            active.setdefault(pattern, 0.0)
        uses = {p: np.unique(p, return_counts=True) for p in active}
        moved = 0.0
        for _ in range(12):
            moved = 0.0
            for pattern, (at, times) in uses.items():
                x = active[pattern]
                now = max(0.0, x + float(residual[at] @ times) / float(times @ times))
                if now != x:
                    residual[at] -= (now - x) * times
                    active[pattern] = now
                    moved = max(moved, abs(now - x))
            if moved < 0.25:
                break
        if len(active) == before and moved < 0.25:
            break
    return list(active), list(active.values())


def plan(histogram: np.ndarray, window: int = WINDOW) -> list:
    """(lengths, copies) patterns that use every piece of the histogram exactly once."""
    left = histogram.astype(np.int64).copy()
    out = []
    if histogram.sum() == 0:
        return out
    patterns, repeats = solve(histogram, window)
    for pattern, x in sorted(zip(patterns, repeats), key=lambda p: (-p[1], p[0])):
        at, times = np.unique(pattern, return_counts=True)
        copies = int(min(np.floor(x + 1e-9), (left[at] // times).min()))
        if copies > 0:
            left[at] -= copies * times
            out.append((tuple(sorted(pattern, reverse=True)), copies))
    while left.any():  # largest first into each sequence; every pattern uses up at least one length
        room, chosen, spare = window, [], left.copy()
        while True:
            fits = np.flatnonzero(spare[:room + 1])
            if len(fits) == 0:
                break
            chosen.append(int(fits[-1]))
            spare[fits[-1]] -= 1
            room -= int(fits[-1])
        at, times = np.unique(chosen, return_counts=True)
        copies = int((left[at] // times).min())
        left[at] -= copies * times
        out.append((tuple(chosen), copies))
    return out


def _slots(patterns: list) -> np.ndarray:
    """Rows (length, first number, first sequence, offset): who fills which place of which pattern."""
    rows, used, sequence = [], {}, 0
    for lengths, copies in patterns:
        offset = 0
        for n in lengths:
            rows.append((n, used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + copies
            offset += n
        sequence += copies
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """(doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset) of every piece."""
    prepare(docs.sparkSession)
    cut = written(pieces(docs, path, window, end), "pieces")
    counts = written(cut.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    histogram = np.zeros(window + 1, np.int64)
    for n, many in by_length.items():
        histogram[n] = many
    whole, histogram[window] = int(histogram[window]), 0
    # whole windows are sequences of their own and come first
    slots = _slots([((window,), whole)] * (whole > 0) + plan(histogram, window))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # length and number in one key, so that one binary search finds the place
        keys = slots[:, 0] * (1 << 48) + slots[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("place").to_numpy()
            at = np.searchsorted(keys, length * (1 << 48) + number, side="right") - 1
            sequence = slots[at, 2] + number - slots[at, 1]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "start", "length", "ids", "doc_tokens")],
                 pa.array(sequence), pa.array(slots[at, 3])],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    numbered = cut.join(offsets, ["task", "length"]).select(
        "doc_id", "start", "length", "ids", "doc_tokens", (F.col("number") + F.col("ahead")).alias("place"))
    placed = numbered.mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, "
                                      "sequence_id long, offset long")
    return placed.select("doc_id", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
