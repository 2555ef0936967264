"""WARC archives as chunked record tables.

A payload is handled as (record, chunk number) rows of about ``CHUNK``
bytes, cut by byte offset at character starts, from the digest pass over writing to reading, and SHA-1 is carried
from chunk to chunk; no step holds a whole record outside the row it came in.

Writing: chunks become WARC 1.1 records (a payload of several chunks is a
segmented record: a response and its continuations), one per line of Spark's
text writer, whose line separator is the end of a WARC record.  So Spark's
commit protocol writes the gzip archives, into any file system it knows.
Payloads that are equal to another record's become revisit records.

Reading: Spark's text reader streams the lines of each gzip archive in order
(gzip files are never split), and a parser in the task turns them into chunk
rows with the running digest and length.

Null html is an empty payload.  A null id is written as an empty one and read
back as null; a null url leaves the record without a target.  Rows with the same
id and payload are records of the same kind.  Only the three named columns are
read.  A truncated or misplaced segment raises an error.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarry.llm.common import bounded_batches

#: Bytes of payload in a chunk row (up to three more or less: cuts are at character starts).
CHUNK = 1 << 16
END = "\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunk_table(df: DataFrame, id_col: str, url_col: str, payload_col: str, keep: tuple[str, ...] = (),
                chunk: int = CHUNK) -> DataFrame:
    """(id, url, key, size, n_chunks, chunk_no, chunk) rows: a record's chunks
    follow each other in one partition, in order.  key tells rows of one id apart."""
    text = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    src = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.xxhash64(text).alias("key"),
                    text.cast("binary").alias("body"), *keep)
    size = F.octet_length("body").cast("long")
    src = src.withColumns({"size": size, "n_chunks": F.greatest(F.lit(1), F.ceil(size / chunk)).cast("int")})
    start, end = _character_start(F.col("body"), F.col("chunk_no") * chunk), _character_start(F.col("body"), (F.col("chunk_no") + 1) * chunk)
    end = F.when(F.col("chunk_no") == F.col("n_chunks") - 1, F.col("size").cast("int")).otherwise(end)
    return src.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1))) \
        .withColumn("chunk", F.substring(F.col("body"), start + 1, end - start).cast("string")).drop("body")


def _character_start(body: Column, at: Column) -> Column:
    """The last start of a character up to byte ``at``, for which at most three
    bytes are looked at.  Bytes are taken by offset, so a cut far into a
    payload costs as much as one at its start."""
    later = lambda back: F.hex(F.substring(body, at + 1 - back, F.lit(1))).between("80", "BF")
    return at - F.when(~later(0), 0).when(~later(1), 1).when(~later(2), 2).otherwise(3)


def payload_digests(chunks: DataFrame) -> DataFrame:
    """(id, key, size, digest) of each record of a chunk table, by one pass
    that carries SHA-1 from chunk to chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = hashlib.sha1()
        for b in batches:
            last, digests = [], []
            for i, (no, n, data) in enumerate(zip(*(b.column(c).to_pylist() for c in (3, 4, 5)))):
                if no == 0:
                    state = hashlib.sha1()
                state.update(data.encode())
                if no == n - 1:
                    last.append(i)
                    digests.append(base32(state.digest()))
            at = pa.array(last, pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in range(3)), pa.array(digests, pa.string())],
                                             names=["id", "key", "size", "digest"])

    src = bounded_batches(chunks.select("id", "key", "size", "chunk_no", "n_chunks", "chunk"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, key long, size long, digest string")


def response_plan(digests: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Distinct (id, key, digest, response id): of equal payloads of at least
    ``min_bytes`` the largest id is the response; smaller ones are their own."""
    best = digests.where(F.col("size") >= min_bytes).groupBy(F.col("digest").alias("d"), F.col("size").alias("s")) \
        .agg(F.max("id").alias("response"))
    return digests.distinct().join(best, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left") \
        .select(F.col("id").alias("_id"), F.col("key").alias("_key"), "digest",
                F.when(F.col("s").isNull(), F.col("id")).otherwise(F.col("response")).alias("response"))


def _urn(c):
    return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))


def write_archives(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_bytes: int = 0, date: str = DATE, chunk: int = CHUNK) -> None:
    """Write one record per row into gzip WARC archives under ``path``."""
    plan = response_plan(payload_digests(chunk_table(df, id_col, url_col, payload_col, chunk=chunk)), min_bytes)
    keyed = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(payload_col).alias("body"),
                      F.xxhash64(F.coalesce(F.col(payload_col).cast("string"), F.lit(""))).alias("hash"))
    rows = keyed.join(plan, F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_key"))) \
        .withColumn("revisit", ~F.col("id").eqNullSafe(F.col("response")))
    rows = rows.withColumn("sent", F.when(F.col("revisit"), "").otherwise(F.col("body")))
    full = F.octet_length(F.coalesce(F.col("body").cast("string"), F.lit(""))).cast("string")
    rows = rows.withColumn("full", full)
    c = chunk_table(rows, "id", "url", "sent", ("digest", "response", "revisit", "full"), chunk)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), "full", F.lit(END))
    first, nl = F.col("chunk_no") == 0, F.lit("\r\n")
    block = F.when(first, F.concat(http, "chunk")).otherwise(F.col("chunk"))
    target = F.regexp_replace("url", r"[\x00-\x20\x7F]", "")
    many = F.col("n_chunks") > 1
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(~first, "continuation").when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), F.when(first, _urn(F.col("id"))).otherwise(
            F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), (F.col("chunk_no") + 1).cast("string"), F.lit(">"))), nl,
        F.when(~first, F.concat(F.lit("WARC-Segment-Origin-ID: "), _urn(F.col("id")), nl)).otherwise(""),
        F.when(many, F.concat(F.lit("WARC-Segment-Number: "), (F.col("chunk_no") + 1).cast("string"), nl)).otherwise(""),
        F.when(many & (F.col("chunk_no") == F.col("n_chunks") - 1), F.concat(
            F.lit("WARC-Segment-Total-Length: "), (F.octet_length(http) + F.col("size")).cast("string"), nl)).otherwise(""),
        F.when(target.isNotNull(), F.concat(F.lit("WARC-Target-URI: "), target, nl)).otherwise(""),
        F.lit(f"WARC-Date: {date}\r\n"),
        F.when(first, F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest", nl)).otherwise(""),
        F.when(F.col("revisit"), F.concat(F.lit(f"WARC-Profile: {REVISIT}\r\nWARC-Refers-To: "), _urn(F.col("response")), nl)).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END))
    c.select(F.concat(head, block).alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


class RecordParser:
    """Turns the lines of an archive into chunk rows; memory is a chunk and a line."""

    def __init__(self, chunk_bytes: int, keep_payload: bool):
        self.chunk_bytes, self.keep = chunk_bytes, keep_payload
        self.rows: list[tuple] = []
        self.head: dict[str, str] | None = None  # of the WARC record being read
        self.left = 0  # bytes of its block still to come
        self.open: dict | None = None  # the logical record, over its segments
        self.http = False  # inside the HTTP header of the block

    def line(self, data: bytes) -> None:
        if self.left:
            body, self.left = data[:self.left], max(0, self.left - len(data))
            self._body(body)
            if not self.left:
                self._end_segment()
        elif self.head is None:
            if data.strip():
                if not data.startswith(b"WARC/"):
                    raise ValueError(f"not a WARC record: {data[:60]!r}")
                self.head = {}
        elif data.strip():
            name, _, value = data.decode("utf-8", "replace").partition(":")
            self.head[name.strip().lower()] = value.strip()
        else:
            self._begin_segment()

    def _begin_segment(self) -> None:
        h = self.head
        self.left = int(h.get("content-length", 0))
        if h.get("warc-type") == "continuation":
            if self.open is None or self.open["id"] != h.get("warc-segment-origin-id") or \
                    int(h["warc-segment-number"]) != self.open["segment"] + 1:
                raise ValueError(f"misplaced segment {h.get('warc-record-id')}")
            self.open["segment"] += 1
        else:
            if self.open is not None:
                raise ValueError("truncated record")
            self.open = {"id": h.get("warc-record-id", ""), "h": h, "segment": int(h.get("warc-segment-number", 0)),
                         "sha": hashlib.sha1(), "size": 0, "no": 0, "buf": [], "buffered": 0, "full": None}
            self.http = h.get("content-type", "").startswith("application/http")
        if not self.left:
            self._end_segment()

    def _body(self, data: bytes) -> None:
        o = self.open
        if self.http:
            if not data.strip():
                self.http = False
            elif data.lower().startswith(b"content-length:"):
                o["full"] = int(data.split(b":")[1])
            return
        for i in range(0, len(data), self.chunk_bytes):
            piece = data[i:i + self.chunk_bytes]
            if o["buffered"] + len(piece) > self.chunk_bytes:
                self._emit(False)
            o["sha"].update(piece)
            o["size"] += len(piece)
            o["buffered"] += len(piece)
            if self.keep:
                o["buf"].append(piece)

    def _end_segment(self) -> None:
        last = self.open["segment"] == 0 or "warc-segment-total-length" in self.head
        self.head = None
        if last:
            self._emit(True)
            self.open = None

    def _emit(self, last: bool) -> None:
        o = self.open
        h = o["h"]
        stated = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
        size, digest = o["size"], base32(o["sha"].digest())
        if h.get("warc-type") == "revisit" and last:  # its payload is elsewhere; the headers describe it
            size, digest = o["full"] if o["full"] is not None else size, stated
        self.rows.append((o["id"], o["no"], last, h.get("warc-type"), h.get("warc-target-uri"), h.get("warc-refers-to"),
                          b"".join(o["buf"]) if self.keep else None, size, digest, stated))
        o["no"], o["buf"], o["buffered"] = o["no"] + 1, [], 0

    def finish(self) -> None:
        """At the end of an archive."""
        if self.left or self.head or self.open is not None:
            raise ValueError("truncated record")

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


CHUNK_ROWS = pa.schema([("record_id", pa.string()), ("chunk_no", pa.int32()), ("last", pa.bool_()), ("warc_type", pa.string()),
                        ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("stated_digest", pa.string())])
CHUNK_DDL = ("record_id string, chunk_no int, last boolean, warc_type string, target_uri string, refers_to string, "
             "payload binary, payload_bytes long, payload_digest string, stated_digest string")


def read_archives(spark: SparkSession, path: str, payload: bool = True, chunk: int = CHUNK) -> DataFrame:
    """Chunk rows of the gzip archives under ``path``: payload_bytes and
    payload_digest run up to and including the chunk, so the row with ``last``
    has those of the full payload."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, file = RecordParser(chunk, payload), None
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if name != file:
                    parser.finish()
                    file = name
                parser.line(data + b"\n")
            if rows := parser.take():
                yield pa.RecordBatch.from_pylist([dict(zip(CHUNK_ROWS.names, r)) for r in rows], schema=CHUNK_ROWS)
        parser.finish()

    lines = spark.read.option("lineSep", "\n").text(path) \
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))
    return bounded_batches(lines).mapInArrow(run, CHUNK_DDL)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record of a chunk table that was read back."""
    ident = F.regexp_extract("record_id", r"<urn:page:(-?\d*)>", 1)
    refers = F.regexp_extract(F.coalesce("refers_to", F.lit("")), r"<urn:page:(-?\d*)>", 1)
    number = lambda c: F.when(c != "", c).cast("long")
    return chunks.where("last").select(number(ident).alias("page_id"), "payload_bytes", "payload_digest", "stated_digest",
                                       F.col("warc_type").alias("record_type"), number(refers).alias("refers_to"), "target_uri")
