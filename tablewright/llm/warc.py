"""A content-addressed archive of WARC records, written out as WARC files and read back.

``write_archive`` stores two tables: ``payloads`` holds every distinct payload once under its SHA-256, in buckets of it, and
``records`` holds the exact header block of every record with the digest of its payload. ``read_archive`` verifies
each stored payload against its address and joins it back to the headers; ``write_files`` writes whole records as WARC files
and ``read_files`` parses such files record by record, by their content lengths. Of records with equal payloads
the one with the smallest id is a response and the others revisit it, unless the payload is smaller than ``least_bytes``.

A hot payload is one row a task before its shuffle, and the digests are joined from stored tables, so that adaptive execution
can split a hot one. Payloads are shuffled once: their buckets stay where they are when records are put together, and revisits
need none.

Defined cases: a null payload is empty; null ids are written as ``null`` and never referred to when another row has an
id; rows with one id and payload are all responses; a null URL leaves its header out; files are UTF-8, so payloads that are
not have to stay in the tables.
"""

from __future__ import annotations

import base64
import datetime
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablewright.llm.shared import buckets_for, give_back, salted_join

#: The digits of base32, the line end of headers and the profile of a revisit.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
LINE = "\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"
#: Columns of the stored payloads; an empty archive has no file to tell them.
PAYLOADS = "address binary, payload binary, id bigint"
#: Pages of a bucket of payloads, which becomes a file.
PAGES = 10_000


def base32(hexadecimal: Column) -> Column:
    """Base32 of hexadecimal digits whose number divides by five, as SHA-1's 40 does."""
    fives = F.sequence(F.lit(0), (F.length(hexadecimal) / 5).cast("int") - 1)

    def four(k: Column) -> Column:
        number = F.conv(F.substr(hexadecimal, k.cast("int") * 5 + 1, F.lit(5)), 16, 10).cast("int")
        digit = lambda shift: F.substr(F.lit(BASE32), F.shiftright(number, shift).bitwiseAND(31) + 1, F.lit(1))
        return F.concat(*(digit(shift) for shift in (15, 10, 5, 0)))

    return F.array_join(F.transform(fives, four), "")


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(LINE))).otherwise("")


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0,
    date: datetime.datetime | None = None,
) -> None:
    """Store the pages below ``path``. ``date`` is when they were fetched, by default now."""
    spark = pages.sparkSession
    date = date or datetime.datetime.now(datetime.timezone.utc)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("address", F.unhex(F.sha2("payload", 256)))
    first = Window.partitionBy("address").orderBy(F.col("id").asc_nulls_last())
    distinct = rows.select("address", "payload", "id").withColumn("rank", F.row_number().over(first)).where("rank = 1").drop("rank")
    # A table is needed to write buckets; it is dropped again, and its files stay.
    table, buckets = f"payloads_{uuid.uuid4().hex}", buckets_for(spark, pages.count(), PAGES)
    writer = distinct.repartition(buckets, "address").write.bucketBy(buckets, "address").option("compression", "zstd")
    writer.option("path", f"{path}/payloads").saveAsTable(table)
    spark.sql(f"DROP TABLE {table}")
    known = spark.read.schema(PAYLOADS).parquet(f"{path}/payloads").select(F.col("address").alias("known"), F.col("id").alias("first"))
    short = rows.select("id", "url", "address", F.length("payload").alias("length"), F.sha1("payload").alias("sha1"))
    records = short.join(known, F.col("address") == F.col("known"))
    revisit = (F.col("length") >= least_bytes) & ~F.col("id").eqNullSafe(F.col("first"))
    kind = F.when(revisit, "revisit").otherwise("response")
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "), F.col("length"), F.lit(LINE * 2)
    )
    header = F.concat(
        F.lit(f"WARC/1.1{LINE}"),
        _header("WARC-Type", kind),
        _header("WARC-Record-ID", _urn(F.col("id"))),
        _header("WARC-Date", F.lit(date.strftime("%Y-%m-%dT%H:%M:%SZ"))),
        _header("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", " ")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        _header("WARC-Refers-To", F.when(revisit, _urn(F.col("first")))),
        _header("WARC-Profile", F.when(revisit, F.lit(REVISIT))),
        _header("Content-Type", F.lit(HTTP)),
        _header("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.length(head) + F.col("length")).cast("string")),
        F.lit(LINE),
    )
    records.select("id", header.alias("header"), F.when(~revisit, head).alias("http"), "address").write.parquet(f"{path}/records")
    spark.range(buckets, buckets + 1).toDF("buckets").coalesce(1).write.parquet(f"{path}/layout")


def _field(name: str, pattern: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: {pattern}\r\n", 1)


def _payloads(spark: SparkSession, path: str) -> DataFrame:
    """Verified payloads with their digests, in the buckets that they were stored in."""
    buckets = spark.read.schema("buckets long").parquet(f"{path}/layout").first()["buckets"]
    table = f"payloads_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} ({PAYLOADS}) USING parquet "
        f"CLUSTERED BY (address) INTO {buckets} BUCKETS LOCATION '{path}/payloads'"
    )
    stored = spark.table(table)
    wrong = F.raise_error(F.concat(F.lit("payload differs from its address "), F.hex("address")))
    intact = F.when(F.unhex(F.sha2("payload", 256)) == F.col("address"), F.col("payload")).otherwise(wrong.cast("binary"))
    found = stored.select(F.col("address").alias("known"), intact.alias("payload"))
    return found.select("known", base32(F.sha1("payload")).alias("payload_digest"), F.length("payload").cast("long").alias("payload_bytes"), "payload")


def read_archive(spark: SparkSession, path: str, revisits: bool = True) -> DataFrame:
    """Every record: ``id``, ``header``, ``http``, ``record_type``, ``refers_to``, ``payload_digest``, ``payload_bytes``,
    ``payload``. Fails on a payload that isn't at its address or not the one its header names. With ``revisits=False``
    those that revisit come without their payload, as files hold them, and are not joined."""
    records = spark.read.parquet(f"{path}/records")
    names = ["payload_digest", "payload_bytes", "payload"]
    own = F.lit(True) if revisits else _field("WARC-Type", r"(\w+)") == "response"
    payloads = _payloads(spark, path)
    joined = records.where(own).join(payloads, F.col("address") == F.col("known")).select(*records.columns, *names)
    if not revisits:
        bare = {"payload_digest": _field("WARC-Payload-Digest", r"sha1:(\w+)"), "payload_bytes": F.lit(None).cast("long"), "payload": F.lit(None).cast("binary")}
        joined = joined.unionByName(records.where(~own).withColumns(bare))
    named = _field("WARC-Payload-Digest", r"sha1:(\w+)")
    refers = F.nullif(_field("WARC-Refers-To", r"<urn:x-page:(-?\d+)>"), F.lit("")).cast("long")
    differs = F.raise_error(F.concat(F.lit("payload differs from its header "), F.col("header"))).cast("string")
    return joined.select(
        "id", "header", "http", _field("WARC-Type", r"(\w+)").alias("record_type"), refers.alias("refers_to"),
        F.when(named == F.col("payload_digest"), named).otherwise(differs).alias("payload_digest"), "payload_bytes", "payload",
    )


def write_files(records: DataFrame, path: str) -> None:
    """Whole records as compressed WARC files (payloads must be UTF-8); revisits carry no payload. A task writes one
    file."""
    block = F.when(F.col("record_type") == "response", F.concat("http", F.col("payload").cast("string"))).otherwise("")
    records.select(F.concat("header", block).alias("value")).write.option("lineSep", LINE * 2).option("compression", "gzip").text(path)


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a WARC file, one at a time; fails where a record ends early or late."""
    while True:
        first = stream.readline()
        if not first:
            return
        if not first.startswith(b"WARC/1."):
            raise ValueError(f"no record begins with {first[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[name] = value
        size = int(fields["Content-Length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut short")
        yield fields, block


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", urn or "")
    return int(found.group(1)) if found else None


def _parsed(fields: dict[str, str], block: bytes) -> dict:
    digest, row = fields["WARC-Payload-Digest"].removeprefix("sha1:"), {}
    if fields["WARC-Type"] == "response":
        payload = block.split(b"\r\n\r\n", 1)[1]
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload differs from its header {fields['WARC-Record-ID']}")
        row = {"payload_bytes": len(payload), "payload": payload}
    return {
        "id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
        "refers_to": _page(fields.get("WARC-Refers-To")), "payload_digest": digest, "payload_bytes": None, "payload": None, **row,
    }


ROW = pa.schema(
    [("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
     ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())]
)


def read_files(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of compressed WARC files, payloads verified against their digests: ``id``, ``url``, ``record_type``,
    ``refers_to``, ``payload_digest``, ``payload_bytes`` and, unless left out, ``payload``, which revisits take from what
    they refer to in size alone. A task holds one compressed file and about a megabyte of its records."""
    schema = ROW if payloads else ROW.remove(ROW.get_field_index("payload"))

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for fields, block in parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                    row = _parsed(fields, block)
                    rows.append(row if payloads else {k: v for k, v in row.items() if k != "payload"})
                    size += len(block) + 500
                    if size > 1 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)
            give_back()

    kinds = "id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long" + (", payload binary" if payloads else "")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    records = files.mapInArrow(run, kinds)
    if payloads:
        return records
    sizes = records.where("record_type = 'response' AND id IS NOT NULL").groupBy(F.col("id").alias("__of")).agg(F.max("payload_bytes").alias("__size"))
    joined = salted_join(records, sizes, [("refers_to", "__of")], "left", 16)
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "__size")).drop("__of", "__size")
