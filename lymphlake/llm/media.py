"""Media columns: lossless audio members in archives, streamed back by a data source."""

from __future__ import annotations

import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lymphlake.llm.common import pieces, sha256_hex
from lymphlake.plans.tables import scratch

FORMAT = "media_archive"
MEMBER_SCHEMA = "archive string, member string, header_offset long, payload binary, error string"
MANIFEST_SCHEMA = "archive string, bytes long, members long"
#: An archive is closed at so many bytes or members; both stay below the limits of plain zip.
ARCHIVE_BYTES, ARCHIVE_MEMBERS = 256 << 20, 50_000
#: A read partition covers about so many bytes of an archive; a batch about so many of payload.
RANGE_BYTES, BATCH_BYTES = 16 << 20, 4 << 20
RATE = 8000


# -- the audio form ---------------------------------------------------------


def to_payload(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes padded by zeros to a positive multiple of 64, and their unpadded number."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + bytes(-len(data) % 64 if data else 64), len(data)


def to_wav(payload: bytes, n_bytes: int) -> bytes:
    """RIFF/WAVE, mono, 8-bit samples; a chunk ``nbyt`` holds the unpadded length."""
    body = b"WAVE" + b"fmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8)
    body += b"nbyt" + struct.pack("<IQ", 8, n_bytes) + b"data" + struct.pack("<I", len(payload)) + payload
    return b"RIFF" + struct.pack("<I", len(body)) + body


def from_wav(media: bytes) -> tuple[bytes, int]:
    """The samples and the unpadded length; ValueError if the form is damaged."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE" or struct.unpack("<I", media[4:8])[0] != len(media) - 8:
        raise ValueError("not a whole RIFF/WAVE member")
    at, samples, n_bytes = 12, None, None
    while at + 8 <= len(media):
        kind, size = struct.unpack("<4sI", media[at : at + 8])
        if kind == b"nbyt":
            n_bytes = struct.unpack("<Q", media[at + 8 : at + 16])[0]
        elif kind == b"data":
            samples = media[at + 8 : at + 8 + size]
            if len(samples) != size:
                raise ValueError("samples are cut short")
        at += 8 + size + size % 2
    if samples is None or n_bytes is None:
        raise ValueError("a chunk is missing")
    return samples, n_bytes


def feature(payload: bytes) -> str:
    """Level, loudness, zero crossings and spectral balance of the samples, a pure function of the bytes."""
    x = np.frombuffer(payload, np.uint8).astype(np.float64) - 128.0
    crossings = int(np.count_nonzero(np.signbit(x[1:]) != np.signbit(x[:-1])))
    frames = np.abs(np.fft.rfft(x.reshape(-1, 64), axis=1)).mean(axis=0)
    bands = [frames[a:b].mean() for a, b in ((0, 2), (2, 8), (8, 16), (16, 33))]
    return f"mean={x.mean():.4f};rms={np.sqrt((x * x).mean()):.4f};zc={crossings};" + ";".join(f"b{i}={b:.3f}" for i, b in enumerate(bands))


# -- writing ----------------------------------------------------------------


def write_archives(docs: DataFrame, name: str = "media", archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Store every text as a member of zip archives in the shared folder; returns the manifest's path.

    Members are named ``<number>/<doc_id>.wav`` (``null.wav`` for a null id),
    so equal texts give equal media. Tasks write archives under names of
    their own; only those of committed tasks are in the manifest, so retried
    and lost tasks leave no doubles.
    """
    folder = scratch(docs.sparkSession, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        system.create_dir(root, recursive=True)
        out = archive = None
        rows: list[tuple[str, int, int]] = []

        def close() -> None:
            archive.close()
            rows.append((path, out.tell(), number))
            out.close()

        number, path = 0, ""
        for batch in pieces(batches, "text"):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if archive is None:
                    path, number = f"{root}/{uuid.uuid4().hex}.zip", 0
                    out = system.open_output_stream(path)
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, allowZip64=True, compresslevel=1)
                archive.writestr(zipfile.ZipInfo(f"{number}/{'null' if doc is None else doc}.wav"), to_wav(*to_payload(text)), zipfile.ZIP_DEFLATED, 1)
                number += 1
                if number >= ARCHIVE_MEMBERS or out.tell() >= archive_bytes:
                    close()
                    archive = None
        if archive is not None:
            close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["archive", "bytes", "members"])

    manifest = f"{folder}-manifest"
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, MANIFEST_SCHEMA).write.parquet(manifest)
    return manifest


# -- reading ----------------------------------------------------------------


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if uri.startswith("file:") or "://" in uri else f"file://{uri}")


def directory(handle, size: int) -> list[tuple[int, str, int, int, int]]:
    """Members ``(header offset, name, method, stored bytes, crc)`` from an archive's central directory."""
    tail = min(size, 22 + 65_535)
    handle.seek(size - tail)
    end = handle.read(tail)
    at = end.rfind(b"PK\x05\x06")
    if at < 0:
        raise OSError("no central directory")
    total, length, start = struct.unpack("<HII", end[at + 10 : at + 20])
    handle.seek(start)
    data, at, out = handle.read(length), 0, []
    for _ in range(total):
        sign, method, crc, stored, n, extra, note, offset = struct.unpack("<4s6xH4xII4xHHH8xI", data[at : at + 46])
        if sign != b"PK\x01\x02":
            raise OSError("a directory entry is damaged")
        out.append((offset, data[at + 46 : at + 46 + n].decode(), method, stored, crc))
        at += 46 + n + extra + note
    return out


def read_member(handle, offset: int, method: int, stored: int, crc: int) -> bytes:
    """One member by the offset of its local header; OSError if its bytes are not what the directory says."""
    handle.seek(offset)
    head = handle.read(30)
    if head[:4] != b"PK\x03\x04":
        raise OSError("no member at this offset")
    n, extra = struct.unpack("<HH", head[26:30])
    handle.seek(offset + 30 + n + extra)
    data = handle.read(stored)
    if method == zipfile.ZIP_DEFLATED:
        try:
            data = zlib.decompress(data, -15)
        except zlib.error as e:
            raise OSError(str(e)) from e
    if zlib.crc32(data) != crc:
        raise OSError("the checksum differs")
    return data


class ArchiveRange(InputPartition):
    """Members whose header lies in ``[start, stop)`` of one archive."""

    def __init__(self, archive: str, size: int, start: int, stop: int):
        super().__init__((archive, start))
        self.archive, self.size, self.start, self.stop = archive, size, start, stop


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.manifest = options["path"]
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.attempts = int(options.get("attempts", 3))

    def partitions(self) -> list[ArchiveRange]:
        """Byte ranges over the archives of the manifest: one entry an archive, not a member."""
        system, path = _open(self.manifest)
        out = []
        for info in system.get_file_info(fs.FileSelector(path)):
            if info.path.endswith(".parquet"):
                with system.open_input_file(info.path) as f:
                    for row in pq.read_table(f, columns=["archive", "bytes"]).to_pylist():
                        for start in range(0, max(1, row["bytes"]), self.range_bytes):
                            out.append(ArchiveRange(row["archive"], row["bytes"], start, min(start + self.range_bytes, row["bytes"])))
        return out or [ArchiveRange("", 0, 0, 0)]

    def read(self, partition: ArchiveRange) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        members = []
        system, path = _open(partition.archive)
        handle = system.open_input_file(path)
        for attempt in range(self.attempts):
            try:
                members = directory(handle, partition.size)
                break
            except OSError:
                if attempt + 1 == self.attempts:
                    raise
                handle = system.open_input_file(path)
        rows, held = [], 0
        for offset, name, method, stored, crc in members:
            if not partition.start <= offset < partition.stop:
                continue
            payload = error = None
            for _ in range(self.attempts):
                try:
                    payload, error = read_member(handle, offset, method, stored, crc), None
                    break
                except OSError as e:  # only this member is read again, through a new handle
                    error = f"{type(e).__name__}: {e}"
                    handle = system.open_input_file(path)
            rows.append((partition.archive, name, offset, payload, error))
            held += len(payload or b"")
            if held >= BATCH_BYTES:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["archive", "member", "header_offset", "payload", "error"])


class MediaArchive(DataSource):
    """``spark.read.format("media_archive").load(manifest)``: one row a member.

    Options: ``rangeBytes`` (bytes of an archive per partition) and
    ``attempts`` (reads of a member before its ``error`` is set and its
    ``payload`` left null; other members are not touched by that).
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MEMBER_SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def read_archives(spark: SparkSession, manifest: str, **options) -> DataFrame:
    spark.dataSource.register(MediaArchive)
    return spark.read.format(FORMAT).options(**options).load(manifest)


FEATURE_SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for name, media, error in zip(*(batch.column(c).to_pylist() for c in ("member", "payload", "error")), strict=True):
            if error is not None:
                raise OSError(f"{name}: {error}")
            payload, n = from_wav(media)
            doc = name.rpartition("/")[2].removesuffix(".wav")
            rows.append((None if doc == "null" else int(doc), n, len(payload), sha256_hex(payload), zlib.crc32(payload[-64:]), len(media), sha256_hex(media), feature(payload)))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in FEATURE_SCHEMA.split(", ")])


def media_features(docs: DataFrame) -> DataFrame:
    """Store every whole text as audio, read it back through the source and describe it.

    Needs ``doc_id, text``. A null or empty text is stored as 64 zero bytes
    with an unpadded length of 0. Repeated rows are members of their own; an
    empty table gives no archive and no row. A member that stays unreadable
    fails the job here, while the source itself only reports it.
    """
    manifest = write_archives(docs)
    return read_archives(docs.sparkSession, manifest).mapInArrow(_features, FEATURE_SCHEMA)
