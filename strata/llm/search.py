"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, no random access.

For every item the documents with the highest score, a sum over the item's
terms of an impact that depends on term and document. Three steps:

1. ``forward``: texts are read once. Of each document the number of its terms
   and the counts of those that some item asks for are written to the shared
   folder; the numbers of documents and terms and the document frequencies are
   aggregated from there.
2. ``resolve``: a task takes its documents in shards of at most ``SHARD``
   documents or ``POSTINGS`` postings (what is larger than that by itself is a
   shard of its own), turns a shard into one list per term in order of impact,
   and runs NRA for every item: it reads a stretch of all lists of the item, each
   stretch four times the last. A document's score then lies between the impacts
   read for it (lower) and those plus the last impact read from each list that it
   was not met in (upper). Reading goes on until no document that was not met
   can reach the k-th best lower bound and the interval of every document that
   can reach it is closed. So membership, ties and scores are final. What a shard
   has found bounds the next one from the start.
3. The k best of each task are merged by a window whose limit is applied in the
   tasks before the shuffle. Shards partition the documents, so this is exact.

Items are taken in blocks of at most ``TERMS`` terms (an item is never cut), as
only a block's terms and lists are held by the tasks and the driver. Document
counts, frequencies and scores cover all documents.

Defined results: null and empty texts have no terms and are found by nothing;
an item without terms (or with terms that no document holds) finds nothing;
repeated ids are documents of their own, each ranked, ties among them by what is
left of the row's order (their rows are equal); a null doc_id is never found (it
could not be named) but counts in the statistics; an empty table gives an empty
result; rows of equal item_id are one item of all their terms; other columns are
not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import prepare, written

K = 50
SHARD = 1 << 14
POSTINGS = 1 << 21
TERMS = 1 << 17
FIRST = 64
GROWTH = 4

# Terms are maximal runs of ASCII digits and letters and of code points over 127; only A-Z is lower-cased.
_TO_TERM = bytes((c + 32 if 65 <= c <= 90 else c) if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | None) -> list:
    """The terms of a text, as UTF-8 bytes, in order and with repeats."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_TERM).split()


class Items:
    """A block of items: their terms by number and the numbers of each item's terms."""

    def __init__(self, of_items: dict):
        self.names = sorted({t for own in of_items.values() for t in own})
        self.number = {t: i for i, t in enumerate(self.names)}
        self.items = {item: np.array(sorted(self.number[t] for t in own), np.int64) for item, own in of_items.items()}


def blocks(items: DataFrame, at_most: int = TERMS) -> Iterator[Items]:
    """The items in blocks of about ``at_most`` terms; rows come to the driver partition by partition."""
    held: dict = {}
    size = 0
    for row in items.where("item_id is not null").select("item_id", "text").orderBy("item_id").toLocalIterator():
        own = set(terms(row["text"]))
        if row["item_id"] not in held and size and size + len(own) > at_most:
            yield Items(held)
            held, size = {}, 0
        held[row["item_id"]] = held.get(row["item_id"], set()) | own
        size += len(own)
    if held:
        yield Items(held)


def forward(docs: DataFrame, of: Items) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document: n counts all its terms, the arrays hold the items' terms only."""
    number = docs.sparkSession.sparkContext.broadcast(of.number)  # at most TERMS terms and those of one item

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value
        asked = known.keys()
        for batch in batches:
            texts = batch.column("text")
            for i in range(0, batch.num_rows, 256):
                n, at, which, tfs = [], [0], [], []
                for text in texts.slice(i, 256).to_pylist():
                    own = terms(text)
                    counts = Counter(own)
                    n.append(len(own))
                    hits = counts.keys() & asked
                    which += map(known.__getitem__, hits)
                    tfs += map(counts.__getitem__, hits)
                    at.append(len(which))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, 256), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(which, pa.int32())),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(tfs, pa.int32()))],
                    names=["doc_id", "n", "terms", "tfs"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, tfs array<int>")


def statistics(stored: DataFrame, of: Items) -> tuple:
    """(N, L, document frequency by term number), over all documents."""
    whole = stored.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(len(of.names), np.int64)
    for row in stored.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
        df[row["t"]] = row["df"]  # as many rows as the block has terms
    return whole["docs"], whole["terms"], df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Lists:
    """A shard's postings: for each term the documents' places and impacts, largest impact first."""

    def __init__(self, places: np.ndarray, which: np.ndarray, tfs: np.ndarray, m: np.ndarray, weight: np.ndarray):
        factor = 1_000_000_000 * tfs // (1000 * tfs + 20 * m[places])
        order = np.lexsort((places, -factor, which))
        self.places, which = places[order], which[order]
        self.impacts = factor[order] * weight[which]
        self.terms, self.begin = np.unique(which, return_index=True)
        self.end = np.append(self.begin[1:], len(which))

    def of(self, numbers: np.ndarray) -> list:
        """(places, impacts) of those of the terms that occur here."""
        at = np.searchsorted(self.terms, numbers)
        here = at < len(self.terms)
        here[here] = self.terms[at[here]] == numbers[here]
        return [(self.places[self.begin[i]:self.end[i]], self.impacts[self.begin[i]:self.end[i]]) for i in at[here]]


def nra(lists: list, size: int, k: int, least: int = 1) -> tuple:
    """Places and final scores of all documents that may be among the k best; ``least``: scores below are of no use.

    Every document whose score reaches the k-th best (and ``least``) is returned, ties included.
    """
    lower = np.zeros(size, np.int64)
    lists = [(p, i) for p, i in lists if len(p) and i[0] > 0]
    read, stretch = 0, FIRST
    while True:
        last = np.zeros(len(lists), np.int64)  # what a document not met in a list can have there at most
        for at, (places, impacts) in enumerate(lists):
            lower[places[read:stretch]] += impacts[read:stretch]
            if stretch < len(places):
                last[at] = impacts[stretch - 1]
        read = stretch
        unmet = int(last.sum())
        upper = lower + unmet
        for at in np.flatnonzero(last):
            upper[lists[at][0][:read]] -= last[at]
        kth = least
        if size > k:
            kth = max(kth, int(np.partition(lower, size - k)[size - k]))
        reach = np.flatnonzero(upper >= kth)
        if unmet < kth and (upper[reach] == lower[reach]).all():
            return reach, lower[reach]
        stretch *= GROWTH


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def resolve(stored: DataFrame, of: Items, n_docs: int, n_terms: int, weight: np.ndarray, k: int) -> DataFrame:
    """(item_id, doc_id, score): the k best of each task's documents for each item."""
    shared = stored.sparkSession.sparkContext.broadcast((of.items, weight))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held, docs, postings = [], 0, 0
        for batch in batches:
            sizes = np.diff(batch.column("terms").offsets.to_numpy())
            start = 0
            while start < batch.num_rows:
                room = np.searchsorted(np.cumsum(sizes[start:]), POSTINGS - postings, "right")
                take = min(SHARD - docs, max(int(room), 0 if held else 1), batch.num_rows - start)
                if take:
                    # a copy: a slice would keep the whole batch, buffers and all
                    held.append(pa.RecordBatch.from_arrays(
                        [pa.concat_arrays([c.slice(start, take)]) for c in batch.columns], schema=batch.schema))
                    docs, postings, start = docs + take, postings + int(sizes[start:start + take].sum()), start + take
                if docs >= SHARD or postings >= POSTINGS or start < batch.num_rows:
                    yield held
                    held, docs, postings = [], 0, 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, w = shared.value
        best: dict = {}
        for held in shards(batches):
            table = pa.Table.from_batches(held)
            ids = table.column("doc_id").to_numpy()
            n = table.column("n").to_numpy()
            lengths, which_n = np.unique(n, return_inverse=True)
            m = np.array([50 + 50 * int(x) * n_docs // n_terms for x in lengths], np.int64)[which_n]
            which, tfs = table.column("terms").combine_chunks(), table.column("tfs").combine_chunks()
            places = np.repeat(np.arange(len(ids)), which.value_lengths().to_numpy())
            lists = Lists(places, which.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64), m, w)
            for item, numbers in items.items():
                old = best.get(item)
                full = old is not None and len(old[0]) >= k
                found, scores = nra(lists.of(numbers), len(ids), k, int(old[1][-1]) if full else 1)
                if len(found):
                    got = (ids[found], scores) if old is None else (
                        np.concatenate([old[0], ids[found]]), np.concatenate([old[1], scores]))
                    best[item] = _best(*got, k)
        for item, (ids, scores) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array([item] * len(ids), item_type), pa.array(ids, id_type),
                                              pa.array(scores, pa.int64())], names=["item_id", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(stored.schema["doc_id"].dataType)
    item_type = pa.infer_type(list(of.items))
    named = {pa.int64(): "long", pa.string(): "string"}[item_type]
    return stored.where("doc_id is not null and size(terms) > 0").mapInArrow(
        run, f"item_id {named}, doc_id {dict(stored.dtypes)['doc_id']}, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score over 0, ties by doc_id.

    ``docs`` has an integer doc_id and a text, ``items`` an item_id (integer or text) and a text.
    """
    spark = docs.sparkSession
    prepare(spark)
    kinds = {f"{c}": t for d in (docs, items) for c, t in d.dtypes if c in ("doc_id", "item_id")}
    found = []
    for of in blocks(items):
        stored = written(forward(docs, of), "forward")
        n_docs, n_terms, df = statistics(stored, of)
        if not n_docs:
            continue
        found.append(resolve(stored, of, n_docs, n_terms, weights(n_docs, df), k)
                     .withColumn("item_id", F.col("item_id").cast(kinds["item_id"])))
    if not found:
        return spark.createDataFrame([], f"item_id {kinds['item_id']}, rank int, doc_id {kinds['doc_id']}, score long")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionAll(more)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id")
    return (whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


# In SQL every document is scored for every item that shares a term with it; what NRA never completes is scored here too.
ORACLE = f"""
with word as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from documents),
doc as (select doc_id, count(*) as n from word group by doc_id),
whole as (select count(*)::hugeint as docs, sum(n)::hugeint as words from doc),
asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from benchmark),
tf as (select doc_id, term, count(*)::hugeint as tf from word where term in (select term from asked) group by doc_id, term),
weight as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::hugeint as w
  from tf, whole group by term, docs),
impact as (
  select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))) as impact
  from tf join doc using (doc_id) join weight using (term), whole),
score as (select item_id, doc_id, sum(impact)::bigint as score from impact join asked using (term) group by item_id, doc_id)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from score where score > 0)
where rank <= {K}
"""
