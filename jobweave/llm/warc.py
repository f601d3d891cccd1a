"""WARC archives and their chunked record table.

Records are written by the executors into gzip-compressed WARC 1.1 files of bounded size in the shared
folder, one gzip member per record, and read back as rows of record identifier and chunk number. Reader
and writer hold one chunk at a time; every chunk row carries the SHA-256 of the payload up to its end, so
that the digest of the last chunk is that of the payload and a reader that stops can tell how far it came.

Defined results: a null payload is an empty one; a null URL has no target header; a null id is written
without number and read back as null; rows with equal id and payload are all the response; empty tables
give an empty manifest and no chunk. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import written

MIN_REVISIT_BYTES = 100
CHUNK_BYTES = 1 << 18
FILE_BYTES = 64 << 20
READ_BYTES = 1 << 16

# Fixed values of the format.
RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"

MANIFEST = "path string, n_records long, n_bytes long"
CHUNKS = (
    "record_id long, record_type string, refers_to long, target_uri string, header_digest string, "
    "chunk_no int, start long, n_bytes int, digest_so_far string, is_last boolean"
)


def payload(html: str = "html") -> Column:
    return F.coalesce(F.col(html), F.lit("")).cast("binary")


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, payload_digest, refers_to: of equal payloads of at least `min_bytes` the
    smallest id is kept whole, and the others refer to it.

    The smallest ids are aggregated per task before they are shuffled; the join back meets only digests
    that occur more than once, and AQE splits a hot one.
    """
    rows = pages.select("page_id", "url", payload().alias("payload")).withColumn("payload_digest", F.sha2("payload", 256))
    first = (
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    repeated = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(first, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_digest", F.when(repeated, F.col("first_id")).alias("refers_to")
    )


def _store(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path) if "://" in path else (pa.fs.LocalFileSystem(), path)


def _urn(number: int | None) -> str:
    return f"<{ID_PREFIX}{'' if number is None else number}>"


def _number(urn: str | None) -> int | None:
    digits = (urn or "").strip("<>").removeprefix(ID_PREFIX)
    return int(digits) if digits else None


def _header(row: dict, n_payload: int) -> tuple[bytes, bytes]:
    """Header of the record, and the HTTP header that opens the block of a response."""
    http = b"" if row["refers_to"] is not None else (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_payload}\r\n\r\n".encode()
    )
    lines = [
        "WARC/1.1",
        f"WARC-Type: {RESPONSE if row['refers_to'] is None else REVISIT}",
        f"WARC-Record-ID: {_urn(row['page_id'])}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
    ]
    if row["url"] is not None:
        # Line ends in a URL would end the header.
        lines.append("WARC-Target-URI: " + row["url"].replace("\r", "%0D").replace("\n", "%0A"))
    if row["refers_to"] is None:
        lines.append("Content-Type: application/http; msgtype=response")
    else:
        lines += [f"WARC-Refers-To: {_urn(row['refers_to'])}", f"WARC-Profile: {PROFILE}"]
    lines.append(f"Content-Length: {len(http) + (n_payload if row['refers_to'] is None else 0)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n", http


def _write_task(folder: str, file_bytes: int, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The attempt is part of the name: a repeated task never writes into the file of another.
        attempt = f"{TaskContext.get().partitionId():05d}-{TaskContext.get().taskAttemptId()}"
        system, base = _store(folder)
        system.create_dir(base, recursive=True)
        out, done, n, size = None, [], 0, 0
        for batch in batches:
            heads = batch.drop_columns(["payload"]).to_pylist()
            for i, row in enumerate(heads):
                if out is None:
                    name = f"{folder}/{attempt}-{len(done):04d}.warc.gz"
                    out, n, size = system.open_output_stream(_store(name)[1], compression=None), 0, 0
                body = memoryview(batch["payload"][i].as_buffer())
                squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
                header, http = _header(row, len(body))
                kept = [header, http]
                if row["refers_to"] is None:
                    kept += [body[at : at + CHUNK_BYTES] for at in range(0, len(body), CHUNK_BYTES)]
                for part in [*kept, b"\r\n\r\n"]:
                    if piece := squeeze.compress(part):
                        size += out.write(piece)
                size += out.write(squeeze.flush())
                n += 1
                if size >= file_bytes:
                    out.close()
                    done.append((name, n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, n, size))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.int64(), pa.int64()))],
                names=["path", "n_records", "n_bytes"],
            )

    return write


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES, level: int = 1) -> DataFrame:
    """Write the rows of `with_revisits` below `folder`; returns the manifest of the files that count."""
    return written(records.mapInArrow(_write_task(folder, file_bytes, level), MANIFEST), "warc-manifest")


class _Inflated:
    """A run of gzip members read piece by piece."""

    def __init__(self, source) -> None:
        self.source, self.inflate, self.raw, self.buffer = source, zlib.decompressobj(31), b"", b""

    def _more(self) -> bool:
        while True:
            if self.inflate.eof:
                self.raw, self.inflate = self.inflate.unused_data or self.raw, zlib.decompressobj(31)
            if not self.raw:
                self.raw = self.source.read(READ_BYTES)
                if not self.raw:
                    return False
            got = self.inflate.decompress(self.raw, READ_BYTES)
            self.raw = b"" if self.inflate.eof else self.inflate.unconsumed_tail
            if got:
                self.buffer += got
                return True

    def line(self) -> bytes:
        while (end := self.buffer.find(b"\r\n")) < 0:
            if not self._more():
                got, self.buffer = self.buffer, b""
                return got
        got, self.buffer = self.buffer[:end], self.buffer[end + 2 :]
        return got

    def take(self, most: int) -> bytes:
        while len(self.buffer) < most and self._more():
            pass
        got, self.buffer = self.buffer[:most], self.buffer[most:]
        return got

    def ended(self) -> bool:
        return not self.buffer and not self._more()


def _fields(stream: _Inflated) -> dict[str, str]:
    found = {}
    while line := stream.line():
        name, _, value = line.decode("utf-8").partition(": ")
        found[name.lower()] = value
    return found


def _records(stream: _Inflated, chunk_bytes: int) -> Iterator[tuple]:
    """Chunk rows of one archive, with the chunk's bytes behind them."""
    while not stream.ended():
        stream.line()
        head = _fields(stream)
        left = int(head["content-length"])
        kind = head["warc-type"]
        if kind == RESPONSE:
            stream.line()
            left = int(_fields(stream)["content-length"])
        digest, at, number = hashlib.sha256(), 0, 0
        while True:
            data = stream.take(min(left, chunk_bytes))
            if len(data) < min(left, chunk_bytes):
                raise ValueError(f"archive ends inside record {head['warc-record-id']}")
            digest.update(data)
            left -= len(data)
            yield (
                _number(head["warc-record-id"]), kind, _number(head.get("warc-refers-to")), head.get("warc-target-uri"),
                head["warc-payload-digest"].removeprefix("sha256:"), number, at, len(data), digest.copy().hexdigest(), not left, data,
            )
            at, number = at + len(data), number + 1
            if not left:
                break
        if stream.line() or stream.line():
            raise ValueError(f"record {head['warc-record-id']} is longer than it says")


def _read_task(chunk_bytes: int, with_data: bool, batch_bytes: int = 4 << 20):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.bool_()]
        names = [part.split()[0] for part in CHUNKS.split(", ")]
        if with_data:
            kinds, names = [*kinds, pa.binary()], [*names, "data"]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        rows, size = [], 0
        for paths in batches:
            for path in paths["path"].to_pylist():
                system, place = _store(path)
                with system.open_input_stream(place, compression=None) as source:
                    for row in _records(_Inflated(source), chunk_bytes):
                        rows.append(row[: len(kinds)])
                        size += 300 + (row[7] if with_data else 0)
                        if size >= batch_bytes:
                            yield batch(rows)
                            rows, size = [], 0
        if rows:
            yield batch(rows)

    return read


def chunk_table(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """Chunk rows of all archives of a manifest, one task per file. `with_data` adds the bytes."""
    schema = CHUNKS + (", data binary" if with_data else "")
    files = max(1, manifest.agg(F.count(F.lit(1))).first()[0])
    return manifest.select("path").repartition(files, "path").mapInArrow(_read_task(chunk_bytes, with_data), schema)


def record_table(chunks: DataFrame) -> DataFrame:
    """One row per record: type, payload length, payload digest and the record it refers to.

    Length and digest of a response are those of the bytes read; a revisit takes the length of the
    response it refers to. The digest in the header of a response must be the one of its bytes.
    """
    last = chunks.where("is_last").withColumn("end", F.col("start") + F.col("n_bytes"))
    stored = last.where(F.col("record_type") == RESPONSE).select(
        "record_id", "record_type", "refers_to", F.col("end").alias("payload_bytes"),
        F.when(F.col("digest_so_far") == F.col("header_digest"), F.col("digest_so_far"))
        .otherwise(F.raise_error(F.concat(F.lit("wrong payload digest in record "), F.col("record_id").cast("string"))))
        .alias("payload_digest"),
    )
    sizes = stored.groupBy(F.col("record_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    again = last.where(F.col("record_type") == REVISIT).select("record_id", "record_type", "refers_to", F.col("header_digest").alias("payload_digest"))
    resolved = again.join(sizes, ["refers_to", "payload_digest"], "left").select(stored.columns)
    return stored.unionByName(resolved)


def round_trip(spark: SparkSession, pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write `pages` as archives to the shared folder and read them back as records."""
    folder = scratch_path(spark, f"warc-{uuid.uuid4().hex[:8]}")
    manifest = write_archives(with_revisits(pages), folder)
    return record_table(written(chunk_table(manifest, chunk_bytes, with_data=False), "warc-chunks"))
