"""Media columns: lossless media members in archives, read through a Spark data source of our own.

Writing: each task stores its payloads as 8-bit grey PNG images (192 samples a row), members of ZIP archives of
bounded size in the shared folder. An archive appears under its final name by a rename, the same name whichever
attempt of the task writes it.

Reading: the data source lists the archives, plans byte ranges over them from their sizes alone, and in each
range reads the archive's directory and those members whose header starts inside the range. Members are read
by offset, checked by CRC and retried one by one; they stream out as Arrow batches of bounded size.

Defined results: null text is empty and gets one row of padding; empty texts likewise; repeated rows each get a
member of their own; equal texts give equal values; an empty table writes no archive and gives no rows; other
columns are ignored. A member that stays unreadable fails the task, so that no row is lost silently.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from inkstrata.llm._shared import fresh_path, tidy, written
from inkstrata.session import table

ROW = 192
ARCHIVE_BYTES = 32 << 20
ARCHIVE_MEMBERS = 20_000
SPLIT_BYTES = 8 << 20
BATCH_BYTES = 4 << 20
ATTEMPTS = 3
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def padded(data: bytes) -> bytes:
    """data with spaces up to a positive multiple of ROW bytes."""
    return data + b" " * (-len(data) % ROW or (0 if data else ROW))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(payload: bytes) -> bytes:
    """payload, a multiple of ROW bytes, as an 8-bit grey image."""
    rows = np.zeros((len(payload) // ROW, ROW + 1), np.uint8)
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    head = struct.pack(">IIBBBBB", ROW, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 5)) + _chunk(b"IEND", b"")


def decode_png(media: bytes) -> np.ndarray:
    """The samples of an 8-bit grey image without interlacing, rows by width."""
    if media[:8] != _SIGNATURE:
        raise ValueError("not a PNG")
    at, width, height, data = 8, 0, 0, []
    while at < len(media):
        (n,), kind = struct.unpack_from(">I", media, at), media[at + 4 : at + 8]
        body = media[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", media, at + 8 + n)[0]:
            raise ValueError(f"damaged chunk {kind!r}")
        if kind == b"IHDR":
            width, height, depth, color, _, _, lace = struct.unpack(">IIBBBBB", body)
            if (depth, color, lace) != (8, 0, 0):
                raise ValueError("only 8-bit grey images without interlacing")
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("only filter type 0")
    return np.ascontiguousarray(rows[:, 1:])


def features(samples: np.ndarray) -> str:
    """Mean, mean step between neighbours, and the share of each of 8 levels, in thousandths; from integers alone."""
    flat = samples.reshape(-1)
    n = len(flat)
    step = int(np.abs(np.diff(flat.astype(np.int16))).sum())
    levels = np.bincount(flat >> 5, minlength=8)
    return f"mean={int(flat.sum(dtype=np.int64)) * 1000 // n};step={step * 1000 // max(1, n - 1)};levels=" + ",".join(str(int(x) * 1000 // n) for x in levels)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system that Spark itself would write it to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return f"file://{found[5:]}" if found.startswith("file:/") and not found.startswith("file://") else found


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _retried(read: Callable, attempts: int, what: str):
    """read()'s result; a failed or short read is tried again, on its own."""
    for attempt in range(attempts):
        try:
            return read()
        except (OSError, EOFError, struct.error, zipfile.BadZipFile) as e:
            failure = e
            time.sleep(0.05 * attempt)
    raise OSError(f"{what}: {failure}")


class _Archives:
    """Rolling ZIP archives of one task."""

    def __init__(self, folder: str, part: int):
        self.fs, self.path = _filesystem(folder)
        self.part, self.count, self.written, self.zip = part, 0, [], None

    def add(self, name: str, note: bytes, media: bytes) -> None:
        if self.zip is None:
            self.body, self.members = io.BytesIO(), 0
            self.zip = zipfile.ZipFile(self.body, "w", zipfile.ZIP_STORED)
        info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
        info.comment = note
        self.zip.writestr(info, media)
        self.members += 1
        if self.members >= ARCHIVE_MEMBERS or self.body.tell() >= ARCHIVE_BYTES:
            self.close()

    def close(self) -> None:
        if self.zip is None:
            return
        self.zip.close()
        self.zip = None
        final = f"{self.path}/part-{self.part:06d}-{self.count:04d}.zip"
        draft = f"{self.path}/_draft-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as out:
            out.write(self.body.getbuffer())
        # a task that runs again writes the same archives: one that is there whole stays, a cut one goes
        there = self.fs.get_file_info(final)
        if there.type == pafs.FileType.File and there.size == self.body.getbuffer().nbytes:
            self.fs.delete_file(draft)
        else:
            if there.type == pafs.FileType.File:
                self.fs.delete_file(final)
            self.fs.move(draft, final)
        self.written.append((final, self.members, len(self.body.getbuffer())))
        self.count += 1


def write_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[str, DataFrame]:
    """Store every text as a media member. Returns the folder of archives, and a table of the archives."""
    folder = qualified(docs.sparkSession, fresh_path(docs.sparkSession, "media"))
    fs, path = _filesystem(folder)
    fs.create_dir(path, recursive=True)
    schema = pa.schema([("archive", pa.string()), ("members", pa.int64()), ("bytes", pa.int64())])

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out, n = _Archives(folder, part), 0
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                data = (text.as_py() or "").encode()
                out.add(f"{part:06d}-{n:09d}.png", json.dumps({"id": key, "bytes": len(data)}).encode(), encode_png(padded(data)))
                n += 1
        out.close()
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in out.written], schema=schema)

    listed = written(docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), "archive string, members long, bytes long"), "archives")
    return folder, listed


class ByteRange(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class MediaReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.attempts = int(options.get("attempts", ATTEMPTS))

    def partitions(self) -> list[ByteRange]:
        fs, path = _filesystem(self.folder)
        found = fs.get_file_info(pafs.FileSelector(path))
        return [ByteRange(f.path, lo, min(lo + self.split, f.size)) for f in sorted(found, key=lambda f: f.path) if f.path.endswith(".zip") for lo in range(0, f.size, self.split)] or [ByteRange("", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = _filesystem(self.folder)


        def listed():
            with fs.open_input_file(partition.path) as f, zipfile.ZipFile(f) as z:
                return [m for m in z.infolist() if partition.start <= m.header_offset < partition.end]

        members = _retried(listed, self.attempts, f"{partition.path}, directory")
        rows, held = [], 0
        for m in members:
            note = json.loads(m.comment)
            rows.append({"id": note["id"], "n_bytes": note["bytes"], "member": m.filename, "start": m.header_offset, "media": self.member(fs, partition.path, m)})
            held += m.file_size
            if held >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, schema=_MEMBERS)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_MEMBERS)

    def member(self, fs: pafs.FileSystem, path: str, m: zipfile.ZipInfo) -> bytes:
        """One member by its offset; a failed or short read is tried again, on its own, by a new handle."""

        def read() -> bytes:
            with fs.open_input_file(path) as f:
                f.seek(m.header_offset)
                head = f.read(30)
                if head[:4] != b"PK\x03\x04":
                    raise OSError("no member header there")
                f.seek(m.header_offset + 30 + sum(struct.unpack("<HH", head[26:30])))
                data = f.read(m.file_size)
            if len(data) != m.file_size or zlib.crc32(data) != m.CRC:
                raise OSError("damaged member")
            return data

        return _retried(read, self.attempts, f"{path}, member {m.filename} at {m.header_offset}")


_MEMBERS = pa.schema([("id", pa.string()), ("n_bytes", pa.int64()), ("member", pa.string()), ("start", pa.int64()), ("media", pa.binary())])


class MediaSource(DataSource):
    """format("inkstrata_media").load(folder): id, n_bytes, member, start, media."""

    @classmethod
    def name(cls) -> str:
        return "inkstrata_media"

    def schema(self) -> str:
        return "id string, n_bytes long, member string, start long, media binary"

    def reader(self, schema) -> MediaReader:
        return MediaReader(self.options)


def read_media(spark: SparkSession, folder: str) -> DataFrame:
    spark.dataSource.register(MediaSource)
    return spark.read.format("inkstrata_media").load(qualified(spark, folder))


def media_features(media: DataFrame) -> DataFrame:
    """id, sizes, digests and features of each member, from the stored bytes."""
    schema = pa.schema([("id", pa.string()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])

    def run(batches):
        for b in batches:
            rows = []
            for data in b.column("media"):
                stored = data.as_py()
                samples = decode_png(stored)
                payload = samples.tobytes()
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), features(samples)))
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[2:])] if rows else [pa.array([], f.type) for f in list(schema)[2:]]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n_bytes"), *arrays], schema=schema)

    return media.select("id", "n_bytes", "media").mapInArrow(tidy(run), "id string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = write_media(table(spark, sf_dir, "documents"))
    found = media_features(read_media(spark, folder))
    return found.select(F.col("id").cast("long").alias("doc_id"), *found.columns[1:])


QUERIES = {"op10_media_columns": op10_media_columns}
ORACLES: dict = {}
