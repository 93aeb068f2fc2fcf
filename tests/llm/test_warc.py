import base64
import glob
import gzip
import hashlib
from collections import defaultdict

from conftest import SF_SMALL

from strata.llm import warc
from strata.llm.queries import op6_warc_segments

HARD = "dup\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"


def expected(rows, least=0):
    ids, first = defaultdict(list), set()
    for page, html in rows:
        ids[html or ""].append(page)
    out = []
    for page, html in rows:
        payload = (html or "").encode()
        known = [i for i in ids[html or ""] if i is not None]
        smallest = min(known) if known else None
        whole = len(payload) < least or len(ids[html or ""]) == 1 or (page == smallest and (html or "") not in first)
        if whole:
            first.add(html or "")
        out.append((page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "response" if whole else "revisit", None if whole else smallest))
    return sorted(out, key=str)


def test_query_as_brute_force(spark):
    rows = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    assert sorted(map(tuple, op6_warc_segments(spark, SF_SMALL).collect()), key=str) == expected(rows)


def test_copies_nulls_long_pages_and_text_that_looks_like_a_record(spark):
    rows = [(None, "u", None), (None, "u", HARD), (1, None, ""), (2, "http://x/\r\nWARC-Type: y", HARD), (3, "z", HARD), (3, "z", HARD),
            (2, "z", HARD), (4, "q", None), (5, "long", "é😀" * 60000), (6, "long", "é😀" * 60000), (7, "a", "x" * 16384), (8, "b", "alone")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as payload")
    want = expected([(p, h) for p, _, h in rows])
    got = warc.write_and_read(df).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == want and all(r["complete"] for r in got)
    few = warc.write_and_read(df, min_bytes=10).collect()
    assert sorted((tuple(r)[:5] for r in few), key=str) == expected([(p, h) for p, _, h in rows], 10)
    assert warc.write_and_read(df.limit(0)).collect() == []


def test_chunks():
    for payload in (b"", b"a", b"\r\n" * 5000, bytes(range(256)) * 100):
        assert warc.dechunked(warc.chunked(payload)) == payload
    for broken in (b"", b"5\r\nabc", b"zz\r\n", b"3\r\nabcX\r\n0\r\n\r\n", b"3\r\nabc\r\n"):
        assert warc.dechunked(broken) is None


def archive(spark, records, path):
    raw = b"".join(h + warc.END + b + warc.END for h, b in records)
    (path / "a").mkdir()
    (path / "a" / "one.warc.gz").write_bytes(gzip.compress(raw))
    return warc.read(spark, f"{path}/a").collect()


def segments(spark, tmp_path):
    page = spark.createDataFrame([(5, "u", "é" * 30000)], "page_id long, url string, html string")
    warc.write(page, f"{tmp_path}/w")
    raw = b"".join(gzip.open(f).read() for f in sorted(glob.glob(f"{tmp_path}/w/*.gz")))
    out = []
    for headers, block in warc.parse(raw):
        lines = "\r\n".join(f"{k}: {v}" for k, v in headers.items())
        out.append((f"WARC/1.1\r\n{lines}".encode(), block))
    return out


def test_segments_in_any_order(spark, tmp_path):
    records = segments(spark, tmp_path)
    assert len(records) > 3
    (row,) = archive(spark, [records[2], *records[3:], records[1], records[0]], tmp_path)
    assert row["complete"] and row["payload"].decode() == "é" * 30000


def test_missing_repeated_and_altered_segments_are_incomplete(spark, tmp_path):
    records = segments(spark, tmp_path)
    head, block = records[1]
    altered = (head, block[:100] + b"ABC" + block[103:])
    for k, broken in enumerate(([*records[:1], *records[2:]], [*records, records[1]], records[:-1], [records[0], altered, *records[2:]])):
        (tmp_path / str(k)).mkdir()
        (row,) = archive(spark, broken, tmp_path / str(k))
        assert not row["complete"]
