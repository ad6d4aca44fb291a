"""WARC archives of pages: written as whole-file gzip streams, normalised to one member a record.

``write_monolithic`` writes archives whose records share one gzip stream, which can only be read from
the start.  ``normalise`` inflates each such file once, as a stream, writes every record as a gzip member
of its own, and a sidecar index of where the members are; ``read`` fetches records by that index.
Archives go to a folder that all tasks reach, under names that a repeated task writes again.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHUNK = 1 << 16
_GZIP = 16 + zlib.MAX_WBITS
_LEVEL = 5
#: Date of capture of every record; pages have none.
_DATE = "1970-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1, as WARC headers have it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: the page's response, or a revisit of page ``refers_to`` without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http;msgtype=response",
    ]
    if refers_to is not None:
        head += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """Fields of one record; the digest of a response is taken from its payload."""
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    number = lambda name: int(x) if (x := fields.get(name, "")[len("<urn:page:") : -1]) else None
    response = fields["WARC-Type"] == "response"
    return {
        "page_id": number("WARC-Record-ID"),
        "payload_bytes": len(payload) if response else int(fields["X-Payload-Length"]),
        "payload_digest": digest(payload) if response else fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To"),
        "payload": payload if response else None,
    }


def records(stream: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records cut from a stream of inflated bytes; only one record is held."""
    held = bytearray()
    need = None
    for part in stream:
        held += part
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                head = bytes(held[:end]).decode().split("\r\n")
                length = next(int(x[16:]) for x in head if x.startswith("Content-Length: "))
                need = end + 4 + length + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError(f"{len(held)} bytes after the last whole record")


def _opened(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


class _Target:
    """A file that appears under its name only when it is complete."""

    def __init__(self, folder: str, name: str) -> None:
        self.system, base = _opened(folder)
        self.system.create_dir(base, recursive=True)
        self.path = f"{base}/{name}"
        self.unfinished = f"{base}/.{name}.{uuid.uuid4().hex}"
        self.stream = self.system.open_output_stream(self.unfinished, compression=None)
        self.size = 0

    def write(self, data: bytes) -> int:
        self.stream.write(data)
        self.size += len(data)
        return len(data)

    def done(self) -> None:
        self.stream.close()
        # Of a repeated task's files the last one stays; all of them are alike.
        if self.system.get_file_info(self.path).type != pyarrow.fs.FileType.NotFound:
            self.system.delete_file(self.path)
        self.system.move(self.unfinished, self.path)


def write_monolithic(pages: DataFrame, folder: str, records_per_file: int = 20_000) -> DataFrame:
    """Write ``pages(page_id, url, html, refers_to)`` to archives; their ``(name, records)``.

    A file is one gzip stream.  A task writes its rows to files of ``records_per_file``, named by the
    task's partition and number.  A page with ``refers_to`` becomes a revisit.  Lazy: nothing is written
    before the result is read.
    """

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        number, count, target, squeeze = 0, 0, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if target is None:
                    target, squeeze = _Target(folder, f"pages-{part:06d}-{number:06d}.warc.gz"), zlib.compressobj(_LEVEL, wbits=_GZIP)
                payload = (row["html"] or "").encode()
                target.write(squeeze.compress(record(row["page_id"], row["url"], payload, row["refers_to"])))
                count += 1
                if count == records_per_file:
                    target.write(squeeze.flush())
                    target.done()
                    yield pa.record_batch({"name": [target.path.rsplit("/", 1)[1]], "records": [count]})
                    number, count, target = number + 1, 0, None
        if target is not None:
            target.write(squeeze.flush())
            target.done()
            yield pa.record_batch({"name": [target.path.rsplit("/", 1)[1]], "records": [count]})

    rows = pages.select(F.col("page_id").cast("long"), "url", "html", F.col("refers_to").cast("long"))
    return rows.mapInArrow(run, "name string, records long")


def normalise(spark: SparkSession, names: DataFrame, folder: str, target_folder: str) -> DataFrame:
    """Rewrite the archives ``names(name)`` of ``folder``, a member a record; the sidecar index.

    ``(name, offset, length)`` of every member of the files of the same names in ``target_folder``.
    Each file also gets ``<name>.idx``, lines of offset and length.  One task takes one file at a time,
    reads it in chunks and holds one record.
    """

    def run(batches):
        system, base = _opened(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                target, places = _Target(target_folder, name), []
                with system.open_input_stream(f"{base}/{name}", compression=None) as source:
                    for raw in records(_inflated(source)):
                        squeeze = zlib.compressobj(_LEVEL, wbits=_GZIP)
                        at = target.size
                        places.append((at, target.write(squeeze.compress(raw) + squeeze.flush())))
                target.done()
                index = _Target(target_folder, f"{name}.idx")
                index.write("".join(f"{at} {length}\n" for at, length in places).encode())
                index.done()
                offsets, lengths = zip(*places)
                yield pa.record_batch({"name": [name] * len(places), "offset": offsets, "length": lengths})

    count = max(1, min(names.count(), 10 * spark.sparkContext.defaultParallelism))
    return names.select("name").repartition(count).mapInArrow(run, "name string, offset long, length long")


def _inflated(source) -> Iterator[bytes]:
    inflate = zlib.decompressobj(wbits=_GZIP)
    while chunk := source.read(_CHUNK):
        while chunk:
            yield inflate.decompress(chunk)
            chunk = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(wbits=_GZIP)
    yield inflate.flush()


def read(index: DataFrame, folder: str) -> DataFrame:
    """Records at the places of ``index(name, offset, length)``, each fetched and inflated by itself.

    ``(page_id, payload_bytes, payload_digest, record_type, refers_to, payload)``; the payload of a
    revisit is null.
    """

    def run(batches):
        system, base = _opened(folder)
        for batch in batches:
            held, source = None, None
            rows = []
            for name, at, length in zip(*[batch.column(c).to_pylist() for c in ("name", "offset", "length")]):
                if name != held:
                    if source is not None:
                        source.close()
                    held, source = name, system.open_input_file(f"{base}/{name}")
                rows.append(parsed(zlib.decompress(source.read_at(length, at), wbits=_GZIP)))
                if len(rows) == 256:
                    yield pa.RecordBatch.from_pylist(rows, _RECORD)
                    rows = []
            if source is not None:
                source.close()
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _RECORD)

    kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return index.mapInArrow(run, kinds)


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages(page_id, url, html)`` with ``refers_to``: the smallest page of equal payload, if another.

    Payloads below ``least_bytes`` are never revisits.  Null html is an empty payload.  Rows without a
    page id, and all rows of the smallest id, stay responses.  Payloads are compared by SHA-256; a hot
    payload is counted down before the shuffle, and only its hash is joined.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("__hash"), F.octet_length(payload).alias("__size"))
    first = rows.groupBy("__hash").agg(F.min("page_id").alias("__first"), F.count("*").alias("__n"))
    again = first.filter("__n > 1").select("__hash", "__first")
    known = rows.join(again, "__hash", "left")
    revisit = (F.col("__first") < F.col("page_id")) & (F.col("__size") >= least_bytes)
    return known.select("page_id", "url", "html", F.when(revisit, F.col("__first")).alias("refers_to"))
