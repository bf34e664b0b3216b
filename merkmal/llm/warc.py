"""Deterministic sharded WARC writer and reader."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from merkmal.llm.common import read_table, shuffle_parts
from merkmal.session import scratch_path

LEAST_REVISIT = 1000
SHARD_BYTES = 256 * 1024 * 1024
ROLL_BYTES = 64 * 1024 * 1024
WARC_DATE = "2024-01-01T00:00:00Z"

MANIFEST = "file string, shard long, part int, n_records long, n_bytes long, sha256 string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, offset long"


def _fs(uri: str):
    """File system and path of a folder; local paths, file:, hdfs:, s3: and gs: work."""
    return arrow_fs.FileSystem.from_uri(uri)


def _record(kind: str, page_id, url, payload: bytes, digest: bytes, refers, date: str) -> bytes:
    """One gzip member holding one record; equal input gives equal bytes."""
    body = b""
    if kind == "response":
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{url}|{digest.hex()}|{kind}")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(digest).decode())
    lines.append("WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode())
    lines.append(f"X-Payload-Length: {len(payload)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"X-Refers-To-Page-Id: {refers}")
    lines.append("Content-Type: application/http;msgtype=response")
    lines.append(f"Content-Length: {len(body)}")
    raw = "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


class _Roller:
    """Files of one shard after each other; a file gets its final name when it is complete."""

    def __init__(self, root: str, shard: int, roll_bytes: int, attempt: int):
        self.fs, self.base = _fs(root)
        self.shard, self.roll, self.attempt, self.part = shard, roll_bytes, attempt, 0
        self.out = None

    def add(self, record: bytes):
        if self.out is None:
            self.name = f"shard-{self.shard:08d}-{self.part:05d}.warc.gz"
            self.temp = f"{self.base}/_temporary-{self.attempt}-{self.name}"
            self.out, self.n, self.size, self.sha = self.fs.open_output_stream(self.temp, compression=None), 0, 0, hashlib.sha256()
        self.out.write(record)
        self.sha.update(record)
        self.n, self.size = self.n + 1, self.size + len(record)
        return self.close() if self.size >= self.roll else None

    def close(self):
        if self.out is None:
            return None
        self.out.close()
        self.fs.move(self.temp, f"{self.base}/{self.name}")
        self.out, line = None, (self.name, self.shard, self.part, self.n, self.size, self.sha.hexdigest())
        self.part += 1
        return line


def revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``(page_id, digest, refers_to)`` of pages that repeat the payload of a page with a larger id.

    Narrow columns only; a hot payload is reduced map-side, and the join back is
    an equi-join that adaptive execution splits. A page without id repeats any
    page with one. Rows that share the largest id are all responses.
    """
    narrow = pages.filter(F.col("n_bytes") >= least).select("page_id", "digest")
    tops = narrow.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1")
    joined = narrow.join(tops.drop("n"), "digest").filter("refers_to is not null and (page_id is null or page_id < refers_to)")
    return joined.select("page_id", "digest", "refers_to").distinct()


def write_warc(pages: DataFrame, root: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES,
               least: int = LEAST_REVISIT, date: str = WARC_DATE) -> DataFrame:
    """Write ``pages (page_id, url, html)`` below ``root``; returns the stored manifest.

    Shards are page_id ranges of equal width, as many as the bytes ask for and
    at least one per shuffle partition; a shard is sorted by page_id, url and
    digest and rolled into files by compressed size. Nothing depends on sampling
    or on the order of input, so the same pages give the same files. A task
    writes under a temporary name and renames; only files in the manifest, which
    is committed last, are part of the archive, so lost tasks leave no trace.
    """
    spark = pages.sparkSession
    body = F.coalesce("html", F.lit(""))
    listed = pages.select("page_id", "url", body.alias("html")).withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    listed = listed.withColumn("n_bytes", F.octet_length("html").cast("long"))
    stats = pages.select("page_id", F.octet_length(body).alias("b")).agg(
        F.min("page_id").alias("low"), F.max("page_id").alias("high"), F.sum(F.col("b").cast("long")).alias("size")).first()
    low, high, total = stats["low"] or 0, stats["high"] or 0, stats["size"] or 0
    parts = max(shuffle_parts(spark), -(-total // shard_bytes))
    width = max(1, -(-(high - low + 1) // parts))
    shard = F.coalesce(F.floor((F.col("page_id") - low) / width), F.lit(0)).cast("long")
    repeats = revisits(listed, least).select(
        shard.alias("shard"), "page_id", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("html"), "digest", "refers_to")
    rows = listed.select(shard.alias("shard"), "page_id", F.lit(1).alias("kind"), "url", "html", "digest", F.lit(None).cast("long").alias("refers_to"))
    ordered = rows.union(repeats).repartition(parts, "shard").sortWithinPartitions("shard", "page_id", "kind", "url", "digest")

    _make_folder(root)

    def write(batches):
        attempt = TaskContext.get().taskAttemptId()
        roller, known, at = None, {}, None
        lines = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "page_id", "kind", "url", "html", "digest", "refers_to"))):
                number, page_id, kind, url, html, digest, refers = row
                if roller is None or roller.shard != number:
                    lines.append(roller.close() if roller else None)
                    roller, known = _Roller(root, number, roll_bytes, attempt), {}
                if at != (number, page_id):
                    known, at = {}, (number, page_id)
                if kind == 0:
                    known[digest] = refers
                    continue
                target = known.get(digest)
                payload = html.encode("utf-8", "surrogatepass")
                record = _record("response" if target is None else "revisit", page_id, url, payload, hashlib.sha1(payload).digest(), target, date)
                lines.append(roller.add(record))
        lines.append(roller.close() if roller else None)
        done = [x for x in lines if x]
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()))],
                names=["file", "shard", "part", "n_records", "n_bytes", "sha256"])

    ordered.mapInArrow(write, MANIFEST).write.mode("error").parquet(f"{root}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def _make_folder(root: str) -> None:
    fs, path = _fs(root)
    fs.create_dir(path, recursive=True)


def _records(stream):
    """``(headers, block, end)`` of each record of an uncompressed WARC stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode("utf-8", "surrogatepass").rstrip("\r\n").partition(": ")
            headers[key] = value
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("record has no end")
        yield headers, block


def read_warc(manifest: DataFrame, root: str) -> DataFrame:
    """One row per record of the files in the manifest; digests are checked against the payloads."""
    files = manifest.select("file").repartition(max(shuffle_parts(manifest.sparkSession), 1), "file")

    def read(batches):
        fs, base = _fs(root)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                out = [[] for _ in range(8)]
                with fs.open_input_stream(f"{base}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for number, (h, block) in enumerate(_records(stream)):
                        digest = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        length = int(h["X-Payload-Length"])
                        if h["WARC-Type"] == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            if len(payload) != length or hashlib.sha1(payload).hexdigest() != digest:
                                raise ValueError(f"{name}: record {number} is damaged")
                        page, refers = h.get("X-Page-Id"), h.get("X-Refers-To-Page-Id")
                        row = (None if page is None else int(page), h.get("WARC-Target-URI"), length, digest, h["WARC-Type"],
                               None if refers is None else int(refers), name, number)
                        for column, value in zip(out, row):
                            column.append(value)
                        if len(out[0]) >= 5000:
                            yield _batch(out)
                            out = [[] for _ in range(8)]
                if out[0]:
                    yield _batch(out)

    return files.mapInArrow(read, RECORDS)


def _batch(out: list[list]) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "file", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC files into the shared folder and read back.

    Null html is an empty payload, null url a record without target, null
    page_id a record without id; equal rows are written as often as they come.
    """
    root = scratch_path(spark, "warc")
    manifest = write_warc(read_table(spark, sf_dir, "pages"), root)
    return read_warc(manifest, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), t AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM t
"""
