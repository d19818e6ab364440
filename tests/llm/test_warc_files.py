"""WARC files written and read back, against plain versions."""

import base64
import hashlib
import io

import pytest

from tablewright.llm import warc
from tablewright.llm.registry import QUERIES
from tests.conftest import SMALL


def plain(pages):
    """Of equal payloads the smallest id is the response."""
    first = {}
    for i, html in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault(html or "", i)
    out = []
    for i, html in pages:
        payload = (html or "").encode()
        revisit = first[html or ""] != i
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((i, len(payload), digest, "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return sorted(out, key=str)


def through_files(spark, df, path):
    warc.write_archive(df, f"{path}/archive")
    warc.write_files(warc.read_archive(spark, f"{path}/archive", revisits=False), f"{path}/files")
    return warc.read_files(spark, f"{path}/files", payloads=False)


def test_what_is_read_back(spark, tmp_path):
    tricky = "WARC/1.1\r\nWARC-Type: response\r\n\r\n"
    pages = [(3, "héllo"), (1, "héllo"), (2, None), (7, ""), (5, "one"), (None, "one"), (8, tricky), (9, "\r\n\r\n"), (10, tricky * 3), (11, "x\x00y\n" * 9000)]
    df = spark.createDataFrame([(i, f"http://{i}" if i != 5 else None, t, "extra") for i, t in pages], "page_id long, url string, html string, id string").repartition(3)
    got = through_files(spark, df, tmp_path)
    rows = [(r["id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got.collect()]
    assert sorted(rows, key=str) == plain(pages)
    whole = {r["id"]: r for r in warc.read_files(spark, f"{tmp_path}/files").collect()}
    assert bytes(whole[10]["payload"]) == (tricky * 3).encode() and whole[3]["payload"] is None and whole[5]["url"] is None
    none = df.limit(0)
    assert through_files(spark, none, tmp_path / "none").count() == 0


def test_the_query(spark):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    rows = [tuple(r[n] for n in names) for r in QUERIES["op9_warc"](spark, SMALL).collect()]
    assert sorted(rows, key=str) == plain(pages)


def test_payloads_stay_in_their_buckets(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    df = spark.createDataFrame([(i, "u", f"page {i % 7}") for i in range(40)], "page_id long, url string, html string")
    warc.write_archive(df, f"{tmp_path}/a")
    plan = warc.read_archive(spark, f"{tmp_path}/a", revisits=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the short records; no payload


def test_broken_files_fail():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:1>\r\nWARC-Payload-Digest: sha1:X\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    assert [block for _, block in warc.parse(io.BytesIO(record * 2))] == [b"abcd"] * 2
    for broken in (record[:-6], record.replace(b": 4", b": 3"), b"junk" + record):
        with pytest.raises(ValueError):
            list(warc.parse(io.BytesIO(broken)))
    with pytest.raises(ValueError, match="differs from its header"):
        warc._parsed({"WARC-Type": "response", "WARC-Payload-Digest": "sha1:X", "WARC-Record-ID": "r"}, b"h\r\n\r\nabcd")
