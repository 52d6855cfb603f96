"""Media columns: texts as lossless grey images in tar archives, read by byte ranges.

The archives are a Spark data source of our own. Each write task streams images into one tar
file with an index of member offsets beside it; the commit names the files of the tasks that
succeeded, so what a lost or repeated task left behind is never read. A read plans byte ranges
of the archives; a range reads the members that begin in it.
"""

from __future__ import annotations

import hashlib
import json
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import shared_folder

#: Samples a row of an image has; payloads are filled with spaces to whole rows.
ROW = 192
RANGE_BYTES, BATCH_BYTES, RETRIES = 8 << 20, 4 << 20, 3
#: Fixed values of the PNG format.
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_BLOCK, _MANIFEST = 512, "_committed.json"
_INDEX = pa.schema([("offset", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("crc32", pa.int64())])
_ROWS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("payload", pa.binary()), ("feature", pa.string())])


def payload_of(data: bytes) -> bytes:
    """The bytes, filled with spaces to a positive multiple of ROW."""
    return data + b" " * (-len(data) % ROW or (0 if data else ROW))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    """An 8-bit grey image, ROW samples wide, of unfiltered rows."""
    rows = len(payload) // ROW
    framed = np.zeros((rows, ROW + 1), np.uint8)
    framed[:, 1:] = np.frombuffer(payload, np.uint8).reshape(rows, ROW)
    header = struct.pack(">IIBBBBB", ROW, rows, 8, 0, 0, 0, 0)
    return PNG_SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(framed.tobytes(), 1)) + _chunk(b"IEND", b"")


def from_png(media: bytes) -> bytes:
    """The samples of an image that to_png made; ValueError if it is damaged."""
    if media[:8] != PNG_SIGNATURE:
        raise ValueError("no PNG signature")
    at, data, shape = 8, [], None
    while at < len(media):
        size, kind = struct.unpack_from(">I4s", media, at)
        body = media[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", media, at + 8 + size)[0] != zlib.crc32(kind + body):
            raise ValueError(f"bad checksum in {kind!r}")
        if kind == b"IHDR":
            shape = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        at += size + 12
    if shape is None or shape[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not an 8-bit grey image")
    framed = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(shape[1], shape[0] + 1)
    if framed[:, 0].any():
        raise ValueError("filtered rows")
    return framed[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """Mean and deviation of the samples, and a 64-bit average hash of the image in 8 x 8 cells."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, ROW).astype(np.float64)
    edges = np.linspace(0, len(image), 9)
    down = np.stack([image[min(int(a), len(image) - 1) : max(int(b), int(a) + 1)].mean(axis=0) for a, b in zip(edges[:-1], edges[1:], strict=True)])
    cells = down.reshape(8, 8, ROW // 8).mean(axis=2)
    bits = np.packbits(cells >= cells.mean()).tobytes().hex()
    return f"{image.mean():.4f}:{image.std():.4f}:{bits}"


@dataclass
class _Written(WriterCommitMessage):
    archive: str | None
    size: int
    members: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, folder = fs.FileSystem.from_uri(self.folder)
        store.create_dir(folder, recursive=True)
        name, at, index = f"{uuid.uuid4().hex}.tar", 0, []
        with store.open_output_stream(f"{folder}/{name}") as out:
            for batch in iterator:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                    media = to_png(payload_of(data))
                    member = tarfile.TarInfo(f"{doc}.png")
                    member.size = len(media)
                    head = member.tobuf(tarfile.USTAR_FORMAT)
                    out.write(head + media + b"\0" * (-len(media) % _BLOCK))
                    index.append((at, doc, len(data), zlib.crc32(media)))
                    at += len(head) + len(media) + -len(media) % _BLOCK
            out.write(b"\0" * 2 * _BLOCK)
        if not index:
            store.delete_file(f"{folder}/{name}")
            return _Written(None, 0, 0)
        table = pa.table([pa.array(c, t) for c, t in zip(zip(*index, strict=True), _INDEX.types, strict=True)], schema=_INDEX)
        with store.open_output_stream(f"{folder}/{name}.idx") as out, pa.ipc.new_file(out, _INDEX) as writer:
            writer.write_table(table)
        return _Written(name, at, len(index))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, folder = fs.FileSystem.from_uri(self.folder)
        store.create_dir(folder, recursive=True)
        kept = [[m.archive, m.size, m.members] for m in messages if m is not None and m.archive]
        # a manifest a commit, so that an append leaves those before it
        name = f"{folder}/{uuid.uuid4().hex}{_MANIFEST}"
        with store.open_output_stream(f"{name}.new") as out:
            out.write(json.dumps(kept).encode())
        store.move(f"{name}.new", name)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, folder = fs.FileSystem.from_uri(self.folder)
        # what other writes stored stays; archives without a manifest are never read
        for m in messages:
            if m is not None and m.archive:
                store.delete_file(f"{folder}/{m.archive}")
                store.delete_file(f"{folder}/{m.archive}.idx")


@dataclass
class _Range(InputPartition):
    archive: str
    start: int
    stop: int


class MemberError(OSError):
    """A member that can't be read after all tries."""


class _Reader(DataSourceReader):
    def __init__(self, folder: str, range_bytes: int, retries: int):
        self.folder, self.range_bytes, self.retries = folder, range_bytes, retries

    def partitions(self) -> list[InputPartition]:
        store, folder = fs.FileSystem.from_uri(self.folder)
        manifests = sorted(i.path for i in store.get_file_info(fs.FileSelector(folder)) if i.path.endswith(_MANIFEST))
        if not manifests:
            raise FileNotFoundError(f"no write to {folder} was committed")
        archives = []
        for path in manifests:
            with store.open_input_stream(path) as f:
                archives += json.loads(f.read())
        return [_Range(name, at, at + self.range_bytes) for name, size, _ in archives for at in range(0, size, self.range_bytes)] or [_Range("", 0, 0)]

    def _member(self, path: str, at: int, crc: int, held: list) -> tuple[bytes, bytes]:
        """A member's media and payload; each failed try opens the archive anew at its offset."""
        why: Exception | None = None
        for _ in range(self.retries + 1):
            try:
                if not held:
                    store, _ = fs.FileSystem.from_uri(self.folder)
                    held.append(store.open_input_file(path))
                file = held[0]
                file.seek(at)
                head = tarfile.TarInfo.frombuf(file.read(_BLOCK), "utf-8", "strict")
                media = file.read(head.size)
                if len(media) != head.size or zlib.crc32(media) != crc:
                    raise ValueError("the stored bytes differ from what was written")
                return media, from_png(media)
            except (OSError, ValueError, zlib.error, struct.error, tarfile.TarError) as e:
                why = e
                held.clear()
        raise MemberError(f"{path} at {at}: {why}")

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        store, folder = fs.FileSystem.from_uri(self.folder)
        path = f"{folder}/{partition.archive}"
        with store.open_input_file(f"{path}.idx") as f:
            index = pa.ipc.open_file(f).read_all()
        offsets = np.asarray(index.column("offset"))
        low, high = np.searchsorted(offsets, (partition.start, partition.stop))
        rows, held, size = [], [], 0
        for at, doc, n, crc in zip(*(c.to_pylist() for c in index.slice(low, high - low).columns), strict=True):
            media, payload = self._member(path, at, crc, held)
            rows.append((doc, n, len(media), hashlib.sha256(media).hexdigest(), payload, feature_of(payload)))
            size += len(payload)
            if size >= BATCH_BYTES:
                yield self._batch(rows)
                rows, size = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ROWS.types, strict=True)], schema=_ROWS)


class MediaArchive(DataSource):
    """`media_archive`: writes (doc_id long, text string), reads the stored images back.

    Options: path; range_bytes, the bytes of an archive that a read task takes; retries, the
    further tries that a member gets by itself.
    """

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return "doc_id long, n_bytes long, media_bytes long, media_sha256 string, payload binary, feature string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(self.options["path"], int(self.options.get("range_bytes", RANGE_BYTES)), int(self.options.get("retries", RETRIES)))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:  # noqa: ANN001
        return _Writer(self.options["path"])


def write_archives(docs: DataFrame, folder: str, *, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Stores every row's text, null as empty, as an image in the folder's archives."""
    docs.sparkSession.dataSource.register(MediaArchive)
    docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).write.format("media_archive").mode("append").save(folder)


def read_archives(spark, folder: str, *, range_bytes: int = RANGE_BYTES, retries: int = RETRIES) -> DataFrame:  # noqa: ANN001
    """doc_id, n_bytes, media_bytes, media_sha256, payload and feature of every stored row."""
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").option("range_bytes", range_bytes).option("retries", retries).load(folder)


def media_columns(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256 and
    feature of every row, from the bytes as they were stored and read back.

    Null texts are empty; an empty text's payload is one row of spaces. Ids, null or repeated,
    pass through; equal texts have equal values; an empty table gives no rows; other columns
    are ignored. The archives stay in the shared folder, as the result reads them.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "media")
    write_archives(docs, folder, id_col=id_col, text_col=text_col)
    return read_archives(spark, folder).select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -16, 16)).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        "feature",
    )
