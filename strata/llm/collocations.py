"""Phrase collocations by best-first growth with bounds from prefix counts.

Per language, phrases of two and three words with ``a >= 10`` occurrences are
scored by their weakest cut, ``a * a / (l * r)`` (l, r: occurrences of the parts),
and those that live mostly inside a longer phrase are dropped.

Growth goes from a word over pairs to triples. The counts of a prefix bound what
can grow from it: a triple ``u v w`` occurs at most as often as ``v w``, so its cut
after ``u`` gives at most ``a / f(u) <= f(u v) / f(u)``. That bound orders the frontier
of pairs. A round takes the best part of the frontier (all pairs of a language
whose bound reaches its threshold), counts the triples that grow from it, and
scores them. With the triples that hold a pair in question as their right part,
which are counted as well, it is settled which pairs live inside longer phrases.
If a language then has ``TOP`` surviving phrases that reach the threshold, no phrase
of the rest of the frontier can come before or tie with them (its score is below
the threshold); otherwise the threshold falls, at last to nothing, and the next
round goes on. The first threshold is the score that ``SLACK * TOP`` pairs reach, so
a language is settled after one round unless most of its best pairs are dropped.

All counts cover all texts. A first pass counts hashes of words and pairs (64 bits;
a clash can only let one more through), which leaves the few that occur ten times;
a second counts those as what they are; each round passes once for its triples.
Tasks count in slices of ``SLICE`` bytes of text with numpy (64 bits of hash with
lengths and first letters tell the phrases of a slice apart) and Spark sums before and after its shuffle, so a
phrase that makes up a third of the corpus is a few rows per task. What tasks look
for reaches them as at most ``SENT`` hashes. When there are more, they count
everything instead, and the round's pairs meet the triples in a shuffle join.
Scores are decimals of 38 digits divided to whole numbers: exact for counts up to
``10 ** 15``.

Defined results: a null text is empty, a null language is ``und``; repeated rows
each count; texts without words and languages without phrases give nothing; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import by_key, prepare, whole_groups, written

TOP = 2000
LEAST = 10
SLACK = 2
STEP = 4
SENT = 2_000_000
SLICE = 8 << 20
HASHES = 1 << 21
SPREAD = 64
COUNT = "decimal(15,0)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Per byte: the end of a piece becomes a line feed, a tab a space, A-Z a-z; words are what is left between.
_CUT = bytes(10 if c in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


_ODD = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F], np.uint64)
_KEEP = np.array([0, *((1 << 8 * k) - 1 for k in range(1, 9))], np.uint64)  # the first k bytes of eight
LONG = 256


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One 64-bit hash of two."""
    h = first * _ODD[0] + second
    h ^= h >> np.uint64(32)
    h *= _ODD[1]
    return h ^ (h >> np.uint64(29))


class Words:
    """The words of a buffer of cut text: where they are, which follow each other in a piece, and their hashes."""

    def __init__(self, raw: bytes):
        self.raw = raw + bytes(8)  # for reads of eight bytes
        letters = np.frombuffer(self.raw, np.uint8)
        gap = (letters == 32) | (letters == 10)
        gap[len(raw):] = True
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if len(raw) and not gap[0]:
            edge = np.append(0, edge)
        self.start, self.end = edge[0::2], edge[1::2]
        piece = np.cumsum(letters == 10, dtype=np.int32)[self.start]
        self.joined = piece[1:] == piece[:-1]  # whether a word and the next are in one piece

    def _eight(self) -> np.ndarray:
        """The eight bytes from every byte on."""
        return np.ndarray((len(self.raw) - 7,), "<u8", self.raw, strides=(1,))

    def heads(self) -> np.ndarray:
        """The first eight bytes and the length of every word."""
        size = self.end - self.start
        return (self._eight()[self.start] & _KEEP[np.minimum(size, 8)]) ^ (size.astype(np.uint64) * _ODD[2])

    def hashes(self, lang: str) -> np.ndarray:
        """64-bit hashes of all words; they depend on the language."""
        from xxhash import xxh64_intdigest as xxh

        start, end, eight = self.start, self.end, self._eight()
        size = end - start
        h = size.astype(np.uint64) * _ODD[2] + np.uint64(xxh(lang.encode()))
        left = np.arange(len(h))
        for at in range(0, LONG, 8):
            x = (h[left] ^ (eight[start[left] + at] & _KEEP[np.minimum(size[left] - at, 8)])) * _ODD[0]
            x ^= x >> np.uint64(29)
            x *= _ODD[1]
            h[left] = x ^ (x >> np.uint64(32))
            left = left[size[left] > at + 8]
            if not len(left):
                return h
        for i in left.tolist():
            h[i] = xxh(self.raw[start[i]:end[i]], int(h[i]))
        return h

    def strings(self, numbers: np.ndarray) -> pa.Array:
        """The words of these numbers."""
        bounds = np.empty(2 * len(self.start), np.int64)
        bounds[0::2], bounds[1::2] = self.start, self.end
        whole = pa.Array.from_buffers(pa.large_string(), max(len(bounds) - 1, 0), [None, pa.py_buffer(bounds), pa.py_buffer(self.raw)])
        return whole.take(pa.array(2 * numbers)).cast(pa.string())


def _in(hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which hashes are among the sorted ``wanted``."""
    if not len(wanted) or not len(hashes):
        return np.zeros(len(hashes), bool)
    here = np.unique(hashes)
    at = np.searchsorted(wanted, here)
    at[at == len(wanted)] = 0
    here = here[wanted[at] == here]
    if not len(here):
        return np.zeros(len(hashes), bool)
    at = np.searchsorted(here, hashes)
    at[at == len(here)] = 0
    return here[at] == hashes


class Slice:
    """Some texts of one language."""

    def __init__(self, lang: str, raw: bytes):
        self.lang, self.words = lang, Words(raw)
        self.h = self.words.hashes(lang)
        self.other = self.words.heads()

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(number of the first word, hash) of all pairs."""
        first = np.flatnonzero(self.words.joined)
        return first, _mixed(self.h[first], self.h[first + 1])

    def counted(self, at: np.ndarray, length: int) -> tuple:
        """(first word, count) of the distinct phrases of ``length`` words that begin at ``at``; [first word: of one of them].

        The hash and the heads of the words tell phrases apart.
        """
        def folded(h: np.ndarray) -> np.ndarray:
            out = h[0]
            for more in h[1:]:
                out = _mixed(out, more)
            return out

        one = folded([self.h[at + k] for k in range(length)])
        order = np.argsort(one)
        one = one[order]
        begin = np.flatnonzero(np.append(True, one[1:] != one[:-1]))[:len(one)]
        size = np.diff(np.append(begin, len(one)))
        other = folded([self.other[at[order] + k] for k in range(length)])
        if (np.repeat(other[begin], size) != other).any():  # a clash: both hashes together
            order = order[np.lexsort((other, one))]
            other = folded([self.other[at[order] + k] for k in range(length)])
            begin = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (other[1:] != other[:-1])))[:len(one)]
            size = np.diff(np.append(begin, len(one)))
        return at[order[begin]], size

    def often(self, wanted: np.ndarray | None) -> Iterator[tuple]:
        """(length, first words, counts) of words and pairs."""
        at, h = self.pairs()
        for length, begin, hashes in ((1, np.arange(len(self.h)), self.h), (2, at, h)):
            yield length, *self.counted(begin if wanted is None else begin[_in(hashes, wanted)], length)

    def triples(self, wanted: np.ndarray | None) -> tuple:
        """(first words, counts) of triples; with ``wanted`` only those whose first pair has its hash there."""
        at, h = self.pairs()
        long = np.append(self.words.joined, [False, False])[at + 1]
        at, h = at[long], h[long]
        return self.counted(at if wanted is None else at[_in(h, wanted)], 3)


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE) -> Iterator[Slice]:
    """Slices of (lang, text) batches; a longer text is cut at the end of a piece."""
    held: dict = {}
    total = 0
    for batch in batches:
        langs, texts = batch.column("lang"), batch.column("text")
        for i in range(0, batch.num_rows, 64):
            for lang, text in zip(langs.slice(i, 64).to_pylist(), texts.slice(i, 64).to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass").translate(_CUT)
                while len(raw) > size:
                    end = raw.rfind(b"\n", 0, size)
                    end = raw.find(b"\n", size) if end < 0 else end
                    if end < 0:
                        break
                    yield Slice(lang, raw[:end])
                    raw = raw[end + 1:]
                held.setdefault(lang, []).append(raw)
                total += len(raw)
                if total >= size:
                    for key in list(held):
                        yield Slice(key, b"\n".join(held.pop(key)))
                    total = 0
    for key in list(held):
        yield Slice(key, b"\n".join(held.pop(key)))


def _texts(documents: DataFrame) -> DataFrame:
    prepare(documents.sparkSession)
    return documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")


def often(documents: DataFrame) -> np.ndarray | None:
    """Sorted hashes of the words and pairs that occur LEAST times (and what clashes with them); None if over SENT.

    The hashes of some slices are dealt by their first bits to a few buckets for every shuffle partition and travel as one
    row per bucket; a task adds the counts of one bucket at a time.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(3, (4 * parts - 1).bit_length())

    def buckets(hashes: list, counts: list) -> pa.RecordBatch:
        h, n = _added(np.concatenate(hashes), np.concatenate(counts))
        bucket = h >> np.uint64(64 - bits)
        begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))[:len(h)]
        ends = np.append(begin[1:], len(h))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[begin].astype(np.int64)), pa.array([h[i:j].tobytes() for i, j in zip(begin, ends)], pa.binary()),
             pa.array([n[i:j].tobytes() for i, j in zip(begin, ends)], pa.binary())], names=["bucket", "h", "n"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, held = [], [], 0
        for part in slices(batches):
            h, n = np.unique(np.concatenate([part.h, part.pairs()[1]]), return_counts=True)
            hashes.append(h)
            counts.append(n)
            held += len(h)
            if held >= HASHES:
                yield buckets(hashes, counts)
                hashes, counts, held = [], [], 0
        if held:
            yield buckets(hashes, counts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "bucket"):
            for _, rows in by_key(group, "bucket"):
                h, n = _added(*(np.frombuffer(b"".join(rows.column(c).to_pylist()), t) for c, t in (("h", np.uint64), ("n", np.int64))))
                yield pa.RecordBatch.from_arrays([pa.array(h[n >= LEAST].view(np.int64))], names=["h"])

    dealt = _texts(documents).mapInArrow(deal, "bucket long, h binary, n binary")
    added = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(add, "h long")
    return _sent(written(added, "often"))


def _added(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, and the sums of their counts."""
    order = np.argsort(hashes)
    h = hashes[order]
    begin = np.flatnonzero(np.append(True, h[1:] != h[:-1]))[:len(h)]
    return h[begin], np.add.reduceat(counts[order], begin) if len(h) else counts


def _sent(hashes: DataFrame) -> np.ndarray | None:
    if hashes.count() > SENT:
        return None
    return np.sort(hashes.toArrow().column("h").to_numpy().view(np.uint64))


def phrases(documents: DataFrame, wanted: np.ndarray | None, length: int) -> DataFrame:
    """(lang, u, v, w, a), counted slice by slice, of words and pairs (``length`` 2) or of triples (3).

    v and w are null in shorter phrases; a row without u counts all words. ``wanted``: the sorted hashes of the words and
    pairs to count, or of the pairs that triples are to begin with; None: all.
    """
    shared = documents.sparkSession.sparkContext.broadcast(wanted)  # at most SENT hashes

    def rows(part: Slice, words: int, at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        columns = [part.words.strings(at + k) for k in range(words)] + [pa.nulls(len(n), pa.string())] * (3 - words)
        return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(part.lang), len(n)), *columns, pa.array(n, pa.int64())],
                                          names=["lang", "u", "v", "w", "a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            if length == 3:
                yield rows(part, 3, *part.triples(shared.value))
                continue
            yield rows(part, 0, np.zeros(1, np.int64), np.array([len(part.h)]))
            for found in part.often(shared.value):
                yield rows(part, *found)

    return (_texts(documents).mapInArrow(run, "lang string, u string, v string, w string, a long")
            .groupBy("lang", "u", "v", "w").agg(F.sum("a").alias("a")))


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    million = F.lit(1000000).cast("decimal(7,0)")
    top = (a.cast(COUNT) * a.cast(COUNT)) * million
    return F.call_function("div", top, left.cast(COUNT) * right.cast(COUNT)).cast("long")


def pair_counts(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, u, v, a, l, r, score, bound) of the pairs that occur LEAST times, (lang, n)."""
    counted = written(phrases(documents, often(documents), 2).where(F.col("u").isNull() | (F.col("a") >= LEAST)), "counts")
    words = counted.where("u is not null and v is null")
    pairs = (counted.where("v is not null").drop("w")
             .join(words.select("lang", "u", F.col("a").alias("l")), ["lang", "u"])
             .join(words.select("lang", F.col("u").alias("v"), F.col("a").alias("r")), ["lang", "v"]))
    pairs = pairs.select("lang", "u", "v", "a", "l", "r", score(F.col("a"), F.col("l"), F.col("r")).alias("score"),
                         # a <= f(u v) and a <= f(v w): the cut after u is at most this
                         score(F.col("a"), F.col("a"), F.col("l")).alias("bound"))
    return written(pairs, "pairs"), counted.where("u is null").select("lang", F.col("a").alias("n"))


def _first(df: DataFrame, top: int, *order) -> DataFrame:
    """The first ``top`` rows of each language, numbered in ``rank``; a large language is cut to size in ``SPREAD`` parts."""
    some = Window.partitionBy("lang", F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD))).orderBy(*order)
    few = df.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def _thresholds(pairs: DataFrame, open_: DataFrame | None, rank: int) -> DataFrame:
    """(lang, least) of the open languages: the score of the pair of that rank, 0 if there are fewer pairs."""
    mine = pairs if open_ is None else pairs.join(F.broadcast(open_), "lang", "left_semi")
    ranked = _first(mine.select("lang", "u", "v", "score"), rank, F.col("score").desc())
    return ranked.groupBy("lang").agg(F.coalesce(F.min(F.when(F.col("rank") == rank, F.col("score"))), F.lit(0)).alias("least"))


def _triples(documents: DataFrame, grown: DataFrame) -> DataFrame:
    """(lang, u, v, w, a) of the triples that grow from the pairs (lang, u, v) of ``grown`` and occur LEAST times."""

    @F.arrow_udf("long")
    def pair_hash(lang: pa.Array, u: pa.Array, v: pa.Array) -> pa.Array:
        out = np.empty(len(lang), np.int64)
        langs = np.array(lang.to_pylist(), object)
        for one in set(langs.tolist()):
            mine = np.flatnonzero(langs == one)
            hashes = [Words("\n".join(x.take(pa.array(mine)).to_pylist()).encode()).hashes(one) for x in (u, v)]
            out[mine] = _mixed(*hashes).view(np.int64)
        return pa.array(out)

    wanted = _sent(grown.select(pair_hash("lang", "u", "v").alias("h")))
    counted = phrases(documents, wanted, 3).where(F.col("a") >= LEAST)
    return counted if wanted is not None else counted.join(grown, ["lang", "u", "v"], "left_semi")


def _round(documents: DataFrame, pairs: DataFrame, least: DataFrame, top: int) -> DataFrame:
    """The surviving phrases that reach their language's threshold (lang, least), the first ``top`` of each language."""
    reach = pairs.join(F.broadcast(least), "lang")  # a row per language
    settle = written(reach.where("score >= least").drop("bound", "least"), "settle")
    # what may outgrow a pair from the left: pairs that end where it begins and occur half as often at least
    before = (pairs.select("lang", "u", F.col("v").alias("x"), "a")
              .join(settle.groupBy("lang", F.col("u").alias("x")).agg(F.min("a").alias("half")), ["lang", "x"])
              .where("2 * a >= half").select("lang", "u", F.col("x").alias("v")))
    grown = written(reach.where("bound >= least").select("lang", "u", "v").unionAll(before).distinct(), "grown")
    found = written(_triples(documents, grown), "triples")

    longer = (found.select("lang", "u", "v", "a").unionAll(found.select("lang", F.col("v").alias("u"), F.col("w").alias("v"), "a"))
              .groupBy("lang", "u", "v").agg(F.max("a").alias("longer")))
    two = (settle.join(longer, ["lang", "u", "v"], "left")
           .where("longer is null or 100 * longer < 50 * a")
           .select("lang", F.concat_ws(" ", "u", "v").alias("phrase"), "a", "l", "r", "score"))
    parts = (found.join(pairs.select("lang", "u", "v", F.col("a").alias("uv"), F.col("l").alias("f_u")), ["lang", "u", "v"])
             .join(pairs.select("lang", F.col("u").alias("v"), F.col("v").alias("w"), F.col("a").alias("vw"), F.col("r").alias("f_w")),
                   ["lang", "v", "w"]))
    first, second = score(F.col("a"), F.col("f_u"), F.col("vw")), score(F.col("a"), F.col("uv"), F.col("f_w"))
    three = (parts.withColumn("first", first).withColumn("second", second).withColumn("by_first", F.expr("first <= second"))
             .select("lang", F.concat_ws(" ", "u", "v", "w").alias("phrase"), "a",
                     F.when(F.col("by_first"), F.col("f_u")).otherwise(F.col("uv")).alias("l"),
                     F.when(F.col("by_first"), F.col("vw")).otherwise(F.col("f_w")).alias("r"),
                     F.least("first", "second").alias("score")))
    whole = two.unionByName(three.join(F.broadcast(least), "lang").where("score >= least").drop("least"))
    return _first(whole, top, F.col("score").desc(), F.col("a").desc(), F.col("phrase"))


def mine(documents: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    pairs, totals = pair_counts(documents)
    done: list[DataFrame] = []
    open_, rank = None, SLACK * top
    while True:
        least = written(_thresholds(pairs, open_, rank), "least")
        if least.isEmpty():
            break
        best = written(_round(documents, pairs, least, top), "best")
        found = least.join(best.groupBy("lang").agg(F.count("*").alias("found")), "lang", "left")
        settled = found.where(F.expr(f"least = 0 or found >= {top}")).select("lang")
        done.append(best.join(F.broadcast(settled), "lang", "left_semi"))
        open_ = written(found.select("lang").join(settled, "lang", "left_anti"), "open")
        rank *= STEP
    whole = done[0] if done else None
    for more in done[1:]:
        whole = whole.unionByName(more)
    if whole is None:
        return documents.sparkSession.createDataFrame(
            [], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    return (whole.join(F.broadcast(totals), "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


ORACLE = f"""
with piece as (
  select coalesce(lang, 'und') as lang, doc_id,
         unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
split as (select lang, [x for x in string_split_regex(piece, '[\\x20\\x09]+') if x <> ''] as ws from piece),
gram as (
  select lang, ws, unnest(range(1, len(ws) + 1)) as i from split where len(ws) > 0),
neighbour as (select lang, ws[i] as u, ws[i + 1] as v, ws[i + 2] as w from gram),
word as (select lang, u, count(*)::hugeint as f from neighbour group by lang, u),
total as (select lang, sum(f)::hugeint as n from word group by lang),
pair as (select lang, u, v, count(*)::hugeint as f from neighbour where v is not null group by lang, u, v),
triple as (select lang, u, v, w, count(*)::hugeint as f from neighbour where w is not null group by lang, u, v, w
           having count(*) >= {LEAST}),
cut as (
  select p.lang, p.u || ' ' || p.v as phrase, p.f as a, 1 as k, x.f as l, y.f as r
  from pair p join word x on x.lang = p.lang and x.u = p.u join word y on y.lang = p.lang and y.u = p.v
  where p.f >= {LEAST}
  union all
  select t.lang, t.u || ' ' || t.v || ' ' || t.w, t.f, 1, x.f, y.f
  from triple t join word x on x.lang = t.lang and x.u = t.u join pair y on y.lang = t.lang and y.u = t.v and y.v = t.w
  union all
  select t.lang, t.u || ' ' || t.v || ' ' || t.w, t.f, 2, x.f, y.f
  from triple t join pair x on x.lang = t.lang and x.u = t.u and x.v = t.v join word y on y.lang = t.lang and y.u = t.w),
scored as (select *, (1000000 * a * a) // (l * r) as score from cut),
weakest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
longer as (
  select lang, phrase, max(f) as f from (
    select lang, u || ' ' || v as phrase, f from triple union all select lang, v || ' ' || w, f from triple)
  group by lang, phrase),
kept as (
  select k.* from weakest k left join longer o on o.lang = k.lang and o.phrase = k.phrase
  where o.f is null or 100 * o.f < 50 * k.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked join total using (lang) where rank <= {TOP}
"""
