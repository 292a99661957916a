"""WARC archives with revisits resolved by payload digest.

Headers alone (id and SHA-1) are shuffled by payload digest; of equal payloads
the record with the largest id is the response, and the others become revisit
records that refer to it.  These decisions, a few bytes a revisit, meet the
records again by id, which spreads evenly however many share a payload; the
join broadcasts the decisions if Spark's threshold lets it, and payloads do not
move at all then.

Archives are ``.warc.gz`` files: a ``warcinfo`` record first, then each record
as a gzip member of its own with fresh headers.  They are written by Spark's
text writer, so any Hadoop store, its commit protocol and task retries work as
for other tables.  That writer ends each row with a separator of at least one
character: it is NUL, the last byte of a member of less than 16 MB (the high
byte of its length), and longer records are cut into several members.

``read_warc`` streams such archives, or those of others (plain, or gzipped with
any members), file by file: a file's compressed bytes and one record are held.

Defined results: a null payload is empty; a null id ranks below all others; of
rows that repeat the largest id with the same payload each is a response (they
are the same record); an empty table writes an archive without records; other
columns of ``pages`` do not matter, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionweave.llm.arrow import bound_batches
from sessionweave.llm.scratch import Scratch

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INFO = b"software: sessionweave\r\nformat: WARC File Format 1.1\r\n"
#: A gzip member of fewer bytes ends with a NUL.
MEMBER = 1 << 24
LEVEL = 5
DIGITS32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(data: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def base32(hexadecimal: Column) -> Column:
    """Base32 of a digest of 160 bits in hexadecimal: five digits are four of base 32."""
    part = lambda k: F.lpad(F.conv(F.substring(hexadecimal, k, 5), 16, 32), 4, "0")
    return F.translate(F.concat(*(part(k) for k in range(1, 41, 5))), "0123456789ABCDEFGHIJKLMNOPQRSTUV", DIGITS32)


def resolve(records: DataFrame, id: str, payload: str, uri: str | None = None) -> DataFrame:
    """``(id, uri, raw, digest, revisit, keeper)`` of each record."""
    base = records.select(
        F.col(f"`{id}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{uri}`").cast("string"), F.lit("")).alias("uri") if uri else F.lit("").alias("uri"),
        F.coalesce(F.col(f"`{payload}`"), F.lit("")).cast("binary").alias("raw"),
    )
    heads = base.select("id", F.sha1("raw").alias("sha"))
    firsts = heads.groupBy("sha").agg(F.max("id").alias("keeper"), F.count("*").alias("n")).filter("n > 1").drop("n")
    again = heads.join(firsts, "sha").filter(~F.col("id").eqNullSafe(F.col("keeper")))
    again = again.select(F.col("id").alias("i"), F.col("sha").alias("s"), "keeper").distinct()
    full = base.withColumn("sha", F.sha1("raw"))
    joined = full.join(again, F.col("id").eqNullSafe(F.col("i")) & (F.col("sha") == F.col("s")), "left")
    return joined.select("id", "uri", "raw", base32(F.col("sha")).alias("digest"), F.col("s").isNotNull().alias("revisit"), "keeper")


def _head(fields: list[tuple[str, str]]) -> bytes:
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n"


def _members(data: bytes) -> Iterator[bytes]:
    """Gzip members, each without its last byte, which is a NUL."""
    for at in range(0, len(data), MEMBER - 1):
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        yield (packer.compress(data[at : at + MEMBER - 1]) + packer.flush())[:-1]


def write_archive(resolved: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write the rows of ``resolve`` as ``.warc.gz`` files below ``path``, one a partition."""
    spark = resolved.sparkSession
    bound_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = False
        for b in batches:
            if not b.num_rows:
                continue
            out = []
            if not opened:
                opened = True
                told = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:record:info>"), ("WARC-Date", date)]
                out += _members(_head([*told, ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(INFO)))]) + INFO + b"\r\n\r\n")
            for row in b.to_pylist():
                raw, name = row["raw"], lambda x: "null" if x is None else x
                fields = [
                    ("WARC-Type", "revisit" if row["revisit"] else "response"),
                    ("WARC-Record-ID", f"<urn:record:{name(row['id'])}>"),
                    ("WARC-Target-URI", "".join(c for c in row["uri"] if c > " " and c != "\x7f")),
                    ("WARC-Date", date),
                    ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
                    ("X-Payload-Length", str(len(raw))),
                    ("Content-Type", "application/http; msgtype=response"),
                ]
                if row["revisit"]:
                    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:record:{name(row['keeper'])}>")]
                block = HTTP if row["revisit"] else HTTP + raw
                out += _members(_head([*fields, ("Content-Length", str(len(block)))]) + block + b"\r\n\r\n")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    rows = resolved.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    rows.write.option("lineSep", "\0").option("compression", "none").text(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for file in fs.listStatus(where):  # names alone, one a partition
        name = file.getPath().getName()
        if name.startswith("part-"):
            fs.rename(file.getPath(), jvm.org.apache.hadoop.fs.Path(where, name.removesuffix(".txt") + ".warc.gz"))


def _plain(data: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """The bytes of a plain or gzipped file, by and by."""
    view = memoryview(data)
    if data[:2] != b"\x1f\x8b":
        yield from (bytes(view[at : at + step]) for at in range(0, len(view), step))
        return
    member = zlib.decompressobj(31)
    for at in range(0, len(view), step):
        rest = bytes(view[at : at + step])
        while rest:
            yield member.decompress(rest)
            rest = member.unused_data
            if member.eof:
                member = zlib.decompressobj(31)


def split_records(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """Header fields and block of each record of one WARC file, gzipped or plain."""
    held, size, fields, need = [], 0, None, 0
    for part in (*_plain(data), None):
        if part:
            held.append(part)
            size += len(part)
        if part is not None and size < need:
            continue
        buffer = b"".join(held)
        at = 0
        while True:
            if fields is None:
                low = buffer.find(b"WARC/1.", at)
                cut = buffer.find(b"\r\n\r\n", low) if low >= 0 else -1
                if cut < 0:
                    at = low if low >= 0 else max(at, len(buffer) - 6)
                    need = 0
                    break
                fields = {}
                for line in buffer[low:cut].split(b"\r\n")[1:]:
                    k, _, v = line.partition(b":")
                    fields[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
                at = cut + 4
            n = int(fields["content-length"])
            if len(buffer) - at < n:
                need = n
                break
            yield fields, buffer[at : at + n]
            at, fields = at + n, None
        held, size = [buffer[at:]], len(buffer) - at
    if fields is not None:
        raise ValueError(f"record {fields.get('warc-record-id')} is cut off: {fields['content-length']} bytes told")


SCHEMA = T.StructType(
    [
        T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()), T.StructField("digest", T.StringType()),
        T.StructField("refers_to", T.StringType()), T.StructField("full_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def _row(fields: dict, block: bytes) -> tuple:
    bare = lambda k: fields[k].strip("<>") if k in fields else None
    http, cut, body = block.partition(b"\r\n\r\n")
    kind, payload = fields.get("warc-type"), body if cut and http.startswith(b"HTTP/") else block
    told = fields.get("warc-payload-digest", "").partition(":")[2] or None
    if kind == "revisit":
        payload = None
    elif kind in ("response", "resource"):
        real = payload_digest(payload)
        if told and told != real:
            raise ValueError(f"record {bare('warc-record-id')}: digest {told} told, {real} found")
        told = real
    size = fields.get("x-payload-length", None if payload is None else len(payload))
    return bare("warc-record-id"), kind, fields.get("warc-target-uri"), told, bare("warc-refers-to"), None if size is None else int(size), payload


def read_warc(spark: SparkSession, path: str, kinds: tuple[str, ...] = ("response", "revisit", "resource")) -> DataFrame:
    """Records of the given kinds of any WARC files; lengths and payload digests are verified."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string()] * 5 + [pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], [f.name for f in SCHEMA.fields])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b["content"].to_pylist():
                rows, size = [], 0
                for fields, block in split_records(data):
                    if fields.get("warc-type") in kinds:
                        rows.append(_row(fields, block))
                        size += len(block)
                    if size > 1 << 20 or len(rows) > 1024:
                        yield batch(rows)
                        rows, size = [], 0
                yield batch(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, SCHEMA)


def archive_pages(pages: DataFrame, id: str = "page_id", payload: str = "html", uri: str | None = "url", path: str | None = None) -> DataFrame:
    """Write the deduplicated archive of ``pages`` and return what its files hold, a row a record."""
    spark = pages.sparkSession
    to = path or Scratch(spark, "warc").path("archive")
    write_archive(resolve(pages, id, payload, uri), to)
    told = lambda c: F.expr(f"try_cast(replace({c}, 'urn:record:', '') as bigint)")
    return read_warc(spark, to).select(
        told("record_id").alias(id),
        F.col("full_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        told("refers_to").alias("refers_to"),
    )
