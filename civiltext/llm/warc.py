"""WARC archives: writing, normalising monolithic gzip files, and reading by index.

An archive that was compressed as one gzip stream can only be read from its start. The
normaliser inflates such a stream once, piece by piece, and writes every record as a gzip
member of its own, with a sidecar index of offsets beside the archive, so that records can be
read singly and in parallel. Every step handles one archive per task and holds one record.

Files go to a folder named by a URI that ``pyarrow.fs`` knows (a local path, ``file:``,
``hdfs:``, ``s3:``, ``gs:``). They are written under a temporary name and moved when complete;
a task that runs again replaces its file by an equal one.

Of pages with equal payloads of at least ``min_revisit`` bytes, the one with the smallest id
is stored as ``response``; others are ``revisit`` records that refer to it and have no payload.
Rows that share that smallest id are all responses; a row without id refers to it like others
(without any id in the group all rows are responses). A missing payload is empty.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

READ_BYTES = 1 << 20
LEVEL = 6
_GZIP = 16 + zlib.MAX_WBITS


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(id_, url: str | None, payload: bytes, size: int, digest: str,
           refers_to=None) -> bytes:
    """One record. ``size`` and ``digest`` are those of the full payload."""
    kind = "response" if refers_to is None else "revisit"
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{json.dumps(id_)}:{url}:{digest}:{kind}")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block += payload if kind == "response" else b""
    # Line ends in an address would end its header line.
    target = " ".join((url or "").split())
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {target}",
             f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-ID: {json.dumps(id_)}",
             f"X-Payload-Length: {size}",
             "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    if kind == "revisit":
        lines[6:6] = ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/"
                      "identical-payload-digest", f"X-Refers-To-Page-ID: {json.dumps(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(data: bytes) -> tuple[dict[str, str], int]:
    """The header fields of the record at the start of ``data``, and where its block starts."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = (line.partition(":") for line in lines[1:])
    return {k.strip().lower(): v.strip() for k, _, v in fields}, end + 4


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated archive that comes in pieces."""
    parts, held, need = [], 0, 0
    for piece in pieces:
        parts.append(piece)
        held += len(piece)
        if held < need:
            continue
        data, at = b"".join(parts), 0
        need = 0
        while True:
            end = data.find(b"\r\n\r\n", at)
            if end < 0:
                break
            fields, start = headers(data[at:end + 4])
            stop = at + start + int(fields["content-length"]) + 4
            if stop > len(data):
                need = stop - at
                break
            yield data[at:stop]
            at = stop
        parts, held = [data[at:]], len(data) - at
    if held:
        raise ValueError("the archive ends inside a record")


def inflate(file) -> Iterator[bytes]:
    """The contents of a gzip file of one or many members, in pieces of bounded size."""
    machine = zlib.decompressobj(_GZIP)
    while data := file.read(READ_BYTES):
        while True:
            out = machine.decompress(data, READ_BYTES)
            if out:
                yield out
            if machine.eof:
                data = machine.unused_data
                machine = zlib.decompressobj(_GZIP)
                if not data:
                    break
            else:
                data = machine.unconsumed_tail
                if not data and len(out) < READ_BYTES:
                    break


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("/"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


class _Replacing:
    """A new file at ``path`` that appears when it is complete."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.store, self.path, self.draft = store, path, f"{path}.{uuid.uuid4().hex}.tmp"

    def __enter__(self):
        self.store.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.file = self.store.open_output_stream(self.draft, compression=None)
        return self.file

    def __exit__(self, kind, *_):
        self.file.close()
        if kind is None:
            self.store.move(self.draft, self.path)
        else:
            self.store.delete_file(self.draft)


def _exists(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type == fs.FileType.File


def _one_task_each(spark: SparkSession, names: list[str]) -> DataFrame:
    """A row per archive, each in a partition of its own."""
    rows = list(enumerate(names))
    frame = spark.createDataFrame(rows, "n int, archive string")
    return frame.repartitionByRange(max(1, len(rows)), "n").select("archive")


def write_monolithic(pages: DataFrame, folder: str, id_col: str = "page_id",
                     url_col: str = "url", payload_col: str = "html",
                     min_revisit: int = 0) -> list[str]:
    """Write ``pages`` as archives of one gzip stream each; returns their names, one per task."""
    pages = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                         F.coalesce(F.col(payload_col), F.lit("")).alias("payload")) \
                 .withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    first = pages.filter(F.octet_length("payload") >= min_revisit).groupBy("digest").agg(
        F.min("id").alias("original"))
    kind = pages.schema["id"].dataType.simpleString()
    rows = pages.join(first, "digest", "left").select(
        "id", "url", "payload", F.when(~F.col("id").eqNullSafe(F.col("original")),
                                       F.col("original")).cast(kind).alias("original"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        name = f"part-{TaskContext.get().partitionId():06d}.warc.gz"
        empty = True
        with _Replacing(store, f"{root}/{name}") as file:
            machine = zlib.compressobj(1, zlib.DEFLATED, _GZIP)
            for batch in batches:
                for id_, url, text, original in zip(*(c.to_pylist() for c in batch.columns)):
                    payload = text.encode()
                    file.write(machine.compress(record(
                        id_, url, payload, len(payload), payload_digest(payload), original)))
                    empty = False
            file.write(machine.flush())
        if empty:
            store.delete_file(f"{root}/{name}")
        else:
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["archive"])

    return sorted(r.archive for r in rows.mapInArrow(run, "archive string").collect())


def normalise(spark: SparkSession, names: list[str], source: str, target: str,
              level: int = LEVEL, remove_source: bool = False) -> None:
    """Rewrite archives so that every record is a gzip member of its own.

    Beside each archive goes ``<name>.index``: a line ``offset length`` per record. With
    ``remove_source`` an archive goes as soon as its rewritten form is complete; a task that runs
    again finds that form instead.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                (store, root), (out, goal) = _open(source), _open(target)
                at = n = 0
                if remove_source and not _exists(store, f"{root}/{name}") \
                        and _exists(out, f"{goal}/{name}.index"):
                    continue
                # The index is complete last: where it stands, the archive does.
                with _Replacing(out, f"{goal}/{name}.index") as index, \
                        _Replacing(out, f"{goal}/{name}") as file, \
                        store.open_input_stream(f"{root}/{name}", compression=None) as mono:
                    for data in records(inflate(mono)):
                        machine = zlib.compressobj(level, zlib.DEFLATED, _GZIP)
                        member = machine.compress(data) + machine.flush()
                        file.write(member)
                        index.write(f"{at} {len(member)}\n".encode())
                        at, n = at + len(member), n + 1
                if remove_source:
                    store.delete_file(f"{root}/{name}")
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["records"])

    _one_task_each(spark, names).mapInArrow(run, "records long").agg(F.sum("records")).collect()
    if remove_source and names:
        store, root = _open(source)
        store.delete_dir(root)


def read_member(file, offset: int, length: int) -> bytes:
    """The record whose gzip member stands at ``offset``."""
    file.seek(offset)
    return zlib.decompress(file.read(length), _GZIP)


def read_records(spark: SparkSession, names: list[str], folder: str,
                 id_type: str = "bigint") -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, payload`` of every
    record, read member by member through the indexes. The digest of a payload is checked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                yield from _read_archive(folder, name)

    return _one_task_each(spark, names).mapInArrow(
        run, "page_id string, payload_bytes long, payload_digest string, record_type string, "
             "refers_to string, payload binary").withColumns({
                 c: F.get_json_object(F.concat(F.lit('{"v":'), c, F.lit("}")), "$.v")
                 .cast(id_type) for c in ("page_id", "refers_to")})


def _read_archive(folder: str, name: str) -> Iterator[pa.RecordBatch]:
    store, root = _open(folder)
    rows, size = [], 0
    with store.open_input_stream(f"{root}/{name}.index", compression=None) as index:
        places = [tuple(map(int, line.split())) for line in index.read().splitlines()]
    with store.open_input_file(f"{root}/{name}") as file:
        for offset, length in places:
            data = read_member(file, offset, length)
            fields, start = headers(data)
            block = data[start:start + int(fields["content-length"])]
            payload = block[block.index(b"\r\n\r\n") + 4:]
            digest = fields["warc-payload-digest"].removeprefix("sha1:")
            if fields["warc-type"] == "response" and payload_digest(payload) != digest:
                raise ValueError(f"record at {offset} of {name} is damaged")
            rows.append((fields["x-page-id"], int(fields["x-payload-length"]), digest,
                         fields["warc-type"], fields.get("x-refers-to-page-id"),
                         payload if fields["warc-type"] == "response" else None))
            size += len(payload)
            if size >= READ_BYTES:
                yield _batch(rows)
                rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
        names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
               "payload"])
