"""WARC archives: writing pages as segmented records and putting the segments together again.

A page becomes a ``response`` record whose block is an HTTP message with the
payload in chunked transfer framing. A block longer than ``SEGMENT`` bytes is
cut: the record holds the first segment, ``continuation`` records name it as
their origin, count on, and the last one gives the total length. Of pages with
equal payloads, the one with the smallest id is the response and the others
are ``revisit`` records that refer to it.

Reading: records are parsed in tasks, file by file. Whole ones are decoded on
the spot. Segments are grouped by origin and ordered by number (a shuffle of
segments only); the origin must have them all and their lengths must add up to
the stated total, then the chunks are decoded. A set with a segment missing,
repeated or of wrong length, and a payload whose digest is not the stated one,
come back with ``complete`` false.

Files are written through Spark's text writer, which takes any bytes as a line
and ends it with the two line breaks that end a record, and read as whole
files of bounded size, so any file system that Spark reaches will do.

Defined results: a null html is the empty payload; null urls are empty; rows
that repeat a page_id are records of their own, and of rows with the smallest
id and one payload only one is the response; null page_ids come after all
others in that choice.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import prepare, written
from strata.session import workspace_path

SEGMENT = 16 * 1024
CHUNK = 4096
RECORDS_A_FILE = 1000
MIN_REVISIT = 0
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a text: eight times five hexadecimal digits as four letters."""
    digest = F.sha1(payload)
    quads = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*quads), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def roles(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, payload, digest, first, revisit) of every page; first: the page that holds a shared payload.

    Digests alone are compared. The payloads move once, to their role: join and numbering
    use one key, the hash of page id and digest.
    """
    with_digest = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("payload")).withColumn("digest", base32_sha1(F.col("payload"))).withColumn(
        "k", F.xxhash64(F.col("page_id").isNull(), "page_id", "digest"))
    small = written(with_digest.select("k", "page_id", "digest", F.octet_length("payload").alias("bytes")), "digests")
    # the first page of a payload by id, null ids last; a payload on one row needs no role
    firsts = (small.where(F.col("bytes") >= min_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1"))
    shared = small.join(firsts, "digest").groupBy("k").agg(F.first("first").alias("first"), F.lit(True).alias("shared"))
    # of rows that repeat the first page, one holds the payload
    place = F.row_number().over(Window.partitionBy("k").orderBy("k"))
    return with_digest.join(shared, "k", "left").withColumn("place", place).select(
        "page_id", "url", "payload", "digest", "first",
        (F.coalesce("shared", F.lit(False)) & ~(F.col("page_id").eqNullSafe(F.col("first")) & (F.col("place") == 1))).alias("revisit"))


def _record(headers: list, block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for i in range(0, len(payload), size):
        part = payload[i:i + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing does not hold."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";", 1)[0], 16)
        except ValueError:
            return None
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if len(body) < at + size + 2 or body[at + size:at + size + 2] != b"\r\n":
            return None
        parts.append(body[at:at + size])
        at += size + 2


def _safe(url: str) -> str:
    """A header holds no line breaks."""
    return re.sub(r"[\r\n\0]", lambda m: f"%{ord(m[0]):02X}", url)


def _few(batches: Iterator[pa.RecordBatch], rows: int = 32) -> Iterator[pa.RecordBatch]:
    """Batches of a few rows: what a task makes of them is all that it holds besides the batch."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, number = TaskContext.get().partitionId(), 0
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    for batch in _few(batches):
        out = []
        for row in batch.to_pylist():
            page, payload = row["page_id"], (row["payload"] or "").encode("utf-8", "surrogatepass")
            number += 1
            name = f"<urn:page:{'' if page is None else page}:{task}-{number}>"
            common = [("WARC-Date", DATE), ("WARC-Target-URI", _safe(row["url"])),
                      ("Page-ID", "" if page is None else page), ("WARC-Payload-Digest", f"sha1:{row['digest']}")]
            if row["revisit"]:
                refers = "" if row["first"] is None else row["first"]
                out.append(_record([("WARC-Type", "revisit"), ("WARC-Record-ID", name), *common,
                                    ("WARC-Profile", PROFILE), ("Refers-To-Page-ID", refers),
                                    ("Content-Type", "application/http; msgtype=response")], head + b"\r\n"))
                continue
            block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
            cuts = [block[i:i + SEGMENT] for i in range(0, len(block), SEGMENT)]
            first = [("WARC-Type", "response"), ("WARC-Record-ID", name), *common,
                     ("Content-Type", "application/http; msgtype=response")]
            out.append(_record([*first, *[("WARC-Segment-Number", 1)] * (len(cuts) > 1)], cuts[0]))
            for k, cut in enumerate(cuts[1:], 2):
                total = [("WARC-Segment-Total-Length", len(block))] * (k == len(cuts))
                out.append(_record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{k}>"),
                                    ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", name),
                                    ("WARC-Segment-Number", k), *total], cut))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def write(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT) -> None:
    """Write pages (page_id, url, html) as gzip-compressed WARC files."""
    prepare(pages.sparkSession)
    (roles(pages, min_bytes)
     .select("page_id", "url", F.when(~F.col("revisit"), F.col("payload")).alias("payload"), "digest", "first", "revisit")
     .mapInArrow(_records, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", END.decode()).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_A_FILE).text(folder))


def parse(content: bytes):
    """(headers by lower-case name, block) of each record of an uncompressed archive."""
    at = 0
    while at < len(content):
        end = content.find(END, at)
        if not content.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no record at byte {at}")
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size, begin = int(headers["content-length"]), end + len(END)
        if begin + size > len(content) or content[begin + size:begin + size + 4] not in (END, b""):
            raise ValueError(f"the record at byte {at} has a wrong length")
        yield headers, content[begin:begin + size]
        at = begin + size + len(END)


def http_payload(block: bytes) -> bytes | None:
    """The body of an HTTP message, its transfer framing decoded; None if that does not hold."""
    head, gap, body = block.partition(END)
    if not gap:
        return None
    framed = re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head)
    return dechunked(body) if framed else body


def _parsed(segments: bool):
    """Records of whole files: either those in segments or those in one piece."""
    names = ["record_id", "page_id", "url", "record_type", "digest", "refers_to", "origin", "number", "total", "block"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(),
             pa.int64(), pa.binary()]
    as_int = lambda v: int(v) if v else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                raw = content.as_py()
                rows = []
                for h, block in parse(zlib.decompress(raw, 47) if raw[:2] == b"\x1f\x8b" else raw):
                    number = as_int(h.get("warc-segment-number"))
                    if (number is not None) != segments:
                        continue
                    name = h.get("warc-record-id")
                    rows.append((name, as_int(h.get("page-id")), h.get("warc-target-uri"), h["warc-type"],
                                 h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                                 as_int(h.get("refers-to-page-id")), h.get("warc-segment-origin-id") or name, number,
                                 as_int(h.get("warc-segment-total-length")), block))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 10, kinds)], names=names)

    return run


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _few(batches):
        payloads, sizes, digests, fine = [], [], [], []
        for block, kind, stated, whole in zip(*(batch.column(c).to_pylist() for c in ("block", "record_type", "digest", "whole"))):
            payload = http_payload(block) if whole and kind == "response" else None
            own = base64.b32encode(hashlib.sha1(payload).digest()).decode() if payload is not None else None
            payloads.append(payload)
            sizes.append(None if payload is None else len(payload))
            digests.append(own)
            fine.append(kind == "revisit" or (payload is not None and stated in (None, own)))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("record_id", "page_id", "url", "record_type", "digest", "refers_to")],
             pa.array(payloads, pa.binary()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
             pa.array(fine, pa.bool_())],
            names=["record_id", "page_id", "url", "record_type", "digest", "refers_to", "payload", "payload_bytes",
                   "payload_digest", "complete"])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(record_id, page_id, url, record_type, digest, refers_to, payload, payload_bytes, payload_digest, complete)
    of every response and revisit record under a folder; ``digest`` is the stated one, ``payload_digest`` that of the payload."""
    prepare(spark)
    files = spark.read.format("binaryFile").load(folder).select("content")
    schema = ("record_id string, page_id long, url string, record_type string, digest string, refers_to long, "
              "origin string, number int, total long, block binary")
    head = ["record_id", "page_id", "url", "record_type", "digest", "refers_to"]
    # the archives are parsed once for either kind, so that whole records need not be kept anywhere
    whole = files.mapInArrow(_parsed(False), schema).select(*head, "block", F.lit(True).alias("whole"))
    parts = files.mapInArrow(_parsed(True), schema)
    grouped = parts.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"), F.max("total").alias("total"),
        F.count("total").alias("ends"), F.max(F.when(F.col("number") == 1, F.struct(*head))).alias("head"))
    numbers = F.transform("parts", lambda p: p["number"])
    # the blocks end to end, as hexadecimal text: strings join, binary arrays do not
    joined = grouped.withColumn("block", F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["block"])), "")))
    again = joined.where(F.col("head").isNotNull()).select(
        *[F.col(f"head.{c}").alias(c) for c in head], "block",
        ((numbers == F.sequence(F.lit(1), F.size("parts"))) & (F.col("ends") == 1)
         & (F.octet_length("block") == F.col("total"))).alias("whole"))
    return whole.unionAll(again).mapInArrow(
        _decoded, "record_id string, page_id long, url string, record_type string, digest string, refers_to long, "
                  "payload binary, payload_bytes long, payload_digest string, complete boolean")


def write_and_read(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Write the archives to a fresh folder; (page_id, payload_bytes, payload_digest, record_type, refers_to) from them.

    What a revisit says of its payload is what the response that it refers to holds.
    """
    folder = workspace_path(pages.sparkSession, "warc")
    write(pages, folder, min_bytes)
    found = written(read(pages.sparkSession, folder).drop("payload", "url"), "archive")
    responses = found.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                             "refers_to", "complete")
    # the response of a shared payload, by digest: one row each
    held = (found.where("record_type = 'response'").groupBy("payload_digest")
            .agg(F.min("payload_bytes").alias("payload_bytes")))
    revisits = (found.where("record_type = 'revisit'").select("page_id", F.col("digest").alias("payload_digest"), "record_type", "refers_to")
                .join(held, "payload_digest", "left")
                .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                        F.col("payload_bytes").isNotNull().alias("complete")))
    return responses.unionAll(revisits)
