"""WARC archives in Zstandard: writing, reading and validating.

An archive begins with a skippable frame that holds its dictionary; each
record is a frame of its own, so that a reader needs no more than one record
in memory at a time.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from acctsentry.llm.common import col, materialized
from acctsentry.operators.skew import join_spread
from acctsentry.session import scratch_path

#: Magic numbers of the format (fixed values).
DICT_MAGIC, FRAME_MAGIC, ZDICT_MAGIC = 0x184D2A5D, b"\x28\xb5\x2f\xfd", b"\x37\xa4\x30\xec"
#: Payloads from this size on are stored once.
REVISIT_BYTES = 1000
#: Uncompressed bytes after which an archive is closed and the next begun.
ARCHIVE_BYTES = 32 << 20
#: Bytes of an archive's first records from which its dictionary is trained, and the dictionary's size.
SAMPLE_BYTES, DICT_BYTES = 1 << 20, 16 << 10
#: Bytes of records that a reader returns at once.
BATCH_BYTES = 4 << 20

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive or a record that breaks the format."""


def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def record_id(page: int | None, nonce: str) -> str:
    return f"<urn:x-page:{'none' if page is None else page}:{nonce}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, original: int | None) -> bytes:
    """One record; a revisit (``original`` given) holds the HTTP head alone."""
    head = http_head(len(payload))
    block = head if original is not None else head + payload
    fields = [
        ("WARC-Type", "response" if original is None else "revisit"),
        ("WARC-Record-ID", record_id(page, digest[:16])),
        ("WARC-Date", datetime.fromtimestamp(0, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
    ]
    if url is not None:
        # A header is one line: line ends and controls of a URL are percent-encoded.
        fields.append(("WARC-Target-URI", "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in url)))
    if original is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(original, digest[:16]))]
    fields.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def train(records: list[bytes]) -> bytes:
    """A dictionary of some first records, cut into pieces so that a few long
    ones give enough to train on too; less than some 2,000 bytes give none."""
    total = sum(min(len(r), SAMPLE_BYTES) for r in records)
    piece = max(128, min(8192, total // 64))
    samples = [r[i : i + piece] for r in records for i in range(0, min(len(r), SAMPLE_BYTES), piece)]
    if len(samples) < 16:
        return b""
    try:
        return zstd.train_dictionary(max(512, min(DICT_BYTES, total // 8)), samples, k=64, d=8, level=3).as_bytes()
    except zstd.ZstdError:
        return b""


def skippable(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary


def packed(records: Iterator[bytes]) -> Iterator[bytes]:
    """An archive's bytes, piece by piece: the dictionary frame, then a frame per record."""
    first, size = [], 0
    for r in records:
        first.append(r)
        size += len(r)
        if size >= SAMPLE_BYTES:
            break
    dictionary = train(first)
    yield skippable(dictionary)
    squeeze = zstd.ZstdCompressor(
        level=3, write_checksum=True, write_content_size=True,
        dict_data=zstd.ZstdCompressionDict(dictionary) if dictionary else None)
    for r in first:
        yield squeeze.compress(r)
    for r in records:
        yield squeeze.compress(r)


def frames(stream: io.RawIOBase) -> Iterator[bytes]:
    """Each record of an archive, decoded from its own frame."""
    head = stream.read(8)
    if len(head) < 8:
        raise WarcError("the archive ends before its dictionary frame")
    magic, length = struct.unpack("<II", head)
    if magic != DICT_MAGIC:
        raise WarcError(f"no dictionary frame in front: {magic:#x}")
    raw = stream.read(length)
    if len(raw) < length:
        raise WarcError("the dictionary frame is cut short")
    if raw[:4] == FRAME_MAGIC:  # the dictionary may be compressed itself
        raw = zstd.ZstdDecompressor().decompress(raw)
    if raw and raw[:4] != ZDICT_MAGIC:
        raise WarcError("the first frame holds no dictionary")
    opener = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(raw) if raw else None)
    rest = b""
    while True:
        rest = rest or stream.read(1 << 16)
        if not rest:
            return
        frame, parts = opener.decompressobj(), []
        try:
            while not frame.eof:
                if not rest:
                    rest = stream.read(1 << 16)
                    if not rest:
                        raise WarcError("a record's frame is cut short")
                parts.append(frame.decompress(rest))
                rest = frame.unused_data if frame.eof else b""
        except zstd.ZstdError as e:
            raise WarcError(f"a frame can't be decoded: {e}") from e
        yield b"".join(parts)


def parsed(data: bytes) -> dict:
    """Headers and payload of one record, checked: version line, mandatory
    fields, block length, the two line ends behind it, and both digests."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise WarcError("no end of the headers")
    version, *lines = data[:end].decode("utf-8").split("\r\n")
    if version not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError(f"version {version!r}")
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in fields:
            raise WarcError(f"header {line!r}")
        fields[name.lower()] = value.strip()
    missing = [f for f in ("warc-type", "warc-record-id", "warc-date", "content-length") if f not in fields]
    if missing:
        raise WarcError(f"headers missing: {missing}")
    if not fields["content-length"].isdecimal():
        raise WarcError("Content-Length is no number")
    length = int(fields["content-length"])
    block = data[end + 4 : end + 4 + length]
    if len(block) != length or data[end + 4 + length :] != b"\r\n\r\n":
        raise WarcError("Content-Length and block differ")
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{hashlib.sha1(block).hexdigest()}":
        raise WarcError("the block's digest differs")
    out = {"type": fields["warc-type"], "id": fields["warc-record-id"], "uri": fields.get("warc-target-uri"),
           "refers_to": fields.get("warc-refers-to"), "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:")}
    head, cut, payload = block.partition(b"\r\n\r\n")
    said = [h.split(b":", 1)[1].strip() for h in head.split(b"\r\n") if h.lower().startswith(b"content-length:")]
    if not cut or len(said) != 1 or not said[0].isdigit():
        raise WarcError("the block is no HTTP response")
    out["length"] = int(said[0])
    if out["type"] == "response":
        if len(payload) != out["length"] or (out["digest"] and hashlib.sha1(payload).hexdigest() != out["digest"]):
            raise WarcError("the payload's length or digest differs")
        out["payload"] = payload
    elif out["type"] == "revisit":
        if out["refers_to"] is None or payload:
            raise WarcError("a revisit names its original and holds no payload")
        out["payload"] = None
    else:
        raise WarcError(f"type {out['type']!r}")
    return out


def page_of(urn: str | None) -> int | None:
    if urn is None:
        return None
    page = urn.removeprefix("<urn:x-page:").partition(":")[0]
    return None if page == "none" else int(page)


MANIFEST = T.StructType([T.StructField("archive", T.StringType()), T.StructField("records", T.LongType())])


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record per row to archives below ``path``; returns the manifest (archive, records).

    Of rows with equal payloads of ``REVISIT_BYTES`` and more, the one with the
    largest id is a response (all of them, if rows share that id) and the
    others are revisits of it. Defined cases: a NULL payload is empty; a NULL
    id is smaller than all others; a NULL URL gives no target header, a URL
    of any length one line; an empty table gives no archive.

    ``path`` is any place that pyarrow's file systems know and that executors
    share. A task writes archives under fresh names and reports them in its
    rows; the manifest is materialised, so archives that a lost or repeated
    task leaves behind are in no manifest and are not read.

    Scale: the owner of each digest comes from a partial aggregate, and the
    owners' table has one row per large payload that occurs twice or more.
    Payloads move once, to meet it by digest (``join_spread`` deals a hot one
    over many tasks), and not at all where AQE finds the table small enough to
    broadcast.
    """
    base = pages.select(
        col(id_col).cast("long").alias("page"), col(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(col(html_col), F.lit("")), "UTF-8").alias("payload")).withColumn("digest", F.sha1("payload"))
    owners = materialized(
        base.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest")
        .agg(F.max("page").alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "owner", "n"))
    known = join_spread(base, owners, ["digest"], "n", F.col("page"), "left").select(
        "page", "url", "payload", "digest",
        F.when(F.col("owner").isNotNull() & ~F.col("page").eqNullSafe(F.col("owner")), F.col("owner")).alias("original"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        rows = (row for b in batches for i in range(0, len(b), 64) for row in b.slice(i, 64).to_pylist())
        count = 0

        def some(first: dict) -> Iterator[bytes]:
            nonlocal count
            size, row = 0, first
            while row is not None:
                r = record(row["page"], row["url"], row["payload"], row["digest"], row["original"])
                size += len(r)
                count += 1
                yield r
                row = next(rows, None) if size < ARCHIVE_BYTES else None

        while (first := next(rows, None)) is not None:
            name, count = f"{uuid.uuid4().hex}.warc.zst", 0
            with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
                for piece in packed(some(first)):
                    out.write(piece)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())], schema=to_arrow_schema(MANIFEST))

    fs, root = pafs.FileSystem.from_uri(path)
    fs.create_dir(root, recursive=True)
    return materialized(known.mapInArrow(write, MANIFEST))


RECORD = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload", T.BinaryType())])


def read_archives(manifest: DataFrame, path: str) -> DataFrame:
    """The records of the manifest's archives below ``path``, each validated;
    ``payload`` is NULL for revisits, whose length and digest are those of the
    full payload.

    A task streams its archives record by record; nothing is shuffled. Raises
    ``WarcError`` in the task for an archive or record that breaks the format,
    and for an archive whose records differ in number from the manifest's.
    """
    schema = to_arrow_schema(RECORD)

    def as_batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found), schema, strict=True)], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for name, n in zip(batch.column("archive").to_pylist(), batch.column("records").to_pylist(), strict=True):
                found, size, seen = [], 0, 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for data in frames(stream):
                        r = parsed(data)
                        seen += 1
                        size += len(data)
                        found.append((page_of(r["id"]), r["uri"], r["type"], page_of(r["refers_to"]), r["length"], r["digest"], r["payload"]))
                        if size >= BATCH_BYTES:
                            yield as_batch(found)
                            found, size = [], 0
                if seen != n:
                    raise WarcError(f"{name} has {seen} records, not {n}")
                if found:
                    yield as_batch(found)

    return manifest.select("archive", "records").mapInArrow(read, RECORD)


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the cluster's shared folder and read them back."""
    path = scratch_path(spark, "warc")
    if ":/" not in path:
        path = "file://" + path
    return read_archives(write_archives(pages, path), path)
