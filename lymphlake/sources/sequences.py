"""FASTA by Spark's text reader, FASTQ by a data source that splits files at records."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

READ_SCHEMA = "id string, description string, seq string, qual string, source_file string"


def read_fasta(spark: SparkSession, paths: str | list[str], source: str | None = None) -> DataFrame:
    """``id, description, seq, source_file``: one row a record, gzip by file name; wrapped lines are joined.

    ``source_file`` is the file's name, or what the first group of the pattern
    ``source`` finds in its whole path.

    A line end with ``>`` behind it is the separator, so a file is split
    between records like any other text and never read as a whole, and a ``>``
    within a definition line belongs to it.
    """
    rows = spark.read.option("lineSep", "\n>").text(paths).withColumn("value", F.regexp_replace("value", r"^\s*>", ""))
    head = F.trim(F.translate(F.split_part("value", F.lit("\n"), F.lit(1)), "\r", ""))
    seq = F.regexp_replace(F.substr("value", F.locate("\n", F.col("value")) + 1), r"\s+", "")
    name = F.col("_metadata.file_path")
    return rows.where(F.regexp_replace("value", r"\s+", "") != "").select(F.split_part(head, F.lit(" "), F.lit(1)).alias("id"), head.alias("description"), F.when(F.locate("\n", F.col("value")) > 0, seq).otherwise("").alias("seq"), (F.regexp_extract(name, source, 1) if source else F.element_at(F.split(name, "/"), -1)).alias("source_file"))


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class FastqRange(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        super().__init__((path, start))
        self.path, self.start, self.stop = path, start, stop


class FastqReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.range_bytes = int(options.get("rangeBytes", 32 << 20))

    def partitions(self) -> list[FastqRange]:
        """Byte ranges of plain files; a gzip file is one partition."""
        system, path = _open(self.path)
        info = system.get_file_info(path)
        files = [info] if info.type == fs.FileType.File else sorted((f for f in system.get_file_info(fs.FileSelector(path, recursive=True)) if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))), key=lambda f: f.path)
        out = []
        for f in files:
            step = f.size if f.path.endswith(".gz") else self.range_bytes
            out += [FastqRange(f.path, a, min(a + step, f.size)) for a in range(0, f.size, max(1, step))]
        return out or [FastqRange("", 0, 0)]

    def read(self, partition: FastqRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, _ = _open(self.path)
        raw = system.open_input_file(partition.path)
        if partition.path.endswith(".gz"):
            lines, at, stop = gzip.open(raw, "rb"), 0, 1 << 62
        else:
            lines, at, stop = _Lines(raw, partition.start), partition.start, partition.stop
            at = lines.to_record()
        rows = []
        name = partition.path.rpartition("/")[2]
        while at < stop:
            record = [lines.readline() for _ in range(4)]
            if not record[0].strip():
                break
            at += sum(map(len, record))
            head, seq, _, qual = (x.decode().rstrip("\r\n") for x in record)
            if head[:1] != "@" or len(seq) != len(qual):
                raise ValueError(f"{name}: no FASTQ record at byte {at}")
            rows.append((head[1:].split(" ")[0], head[1:], seq, qual, name))
            if len(rows) == 10_000:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


class _Lines:
    """Buffered lines of a file from a byte on."""

    def __init__(self, raw, start: int):
        self.raw, self.start, self.held, self.at = raw, start, b"", 0
        raw.seek(start)

    def readline(self) -> bytes:
        while True:
            end = self.held.find(b"\n", self.at)
            if end >= 0:
                out, self.at = self.held[self.at : end + 1], end + 1
                return out
            more = self.raw.read(1 << 20)
            if not more:
                out, self.at = self.held[self.at :], len(self.held)
                return out
            self.held, self.at = self.held[self.at :] + more, 0

    def to_record(self) -> int:
        """Go to the first record that starts at or behind the byte; returns its place.

        A quality line may start with @ too: a record is an @ line whose next
        but one starts with + and whose sequence and quality are equally long.
        """
        if self.start == 0:
            return 0
        self.start -= 1
        self.raw.seek(self.start)
        self.held, self.at = b"", 0
        offset = self.start + len(self.readline())
        window = [self.readline() for _ in range(4)]
        while window[0]:
            a, b, c, d = window
            if a[:1] == b"@" and c[:1] == b"+" and len(b.strip()) == len(d.strip()):
                break
            offset += len(window.pop(0))
            window.append(self.readline())
        self.raw.seek(offset)
        self.held, self.at = b"", 0
        return offset


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=["id", "description", "seq", "qual", "source_file"])


class Fastq(DataSource):
    """``spark.read.format("fastq_reads").load(path)``; option ``rangeBytes``."""

    @classmethod
    def name(cls) -> str:
        return "fastq_reads"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options)


def read_fastq(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(Fastq)
    return spark.read.format("fastq_reads").options(**options).load(path)


def attributes(description: Column) -> Column:
    """Map of the ``key=value`` words of a definition line."""
    words = F.filter(F.split(description, r"[\s;]+"), lambda w: w.contains("="))
    return F.map_from_entries(F.array_distinct(F.transform(words, lambda w: F.struct(F.split_part(w, F.lit("="), F.lit(1)).alias("key"), F.substr(w, F.locate("=", w) + 1).alias("value")))))


def read_lookup(description: Column) -> Column:
    """Struct ``duplicate_count, consensus_count, cell_id`` of a definition line; with ``;size=`` only that counts."""
    size = F.regexp_extract(description, r";size=(\d+)", 1)

    def named(pattern):
        found = F.regexp_extract(description, pattern, 1)
        return F.when((size == "") & (found != "") & (found != "NA"), found)

    dup = F.coalesce(F.when(size != "", size), named(r"(?:duplicate_count|umi_count)=(\d+)"))
    return F.struct(dup.cast("long").alias("duplicate_count"), named(r"(?:consensus_count|total_reads)=(\d+)").cast("long").alias("consensus_count"), named(r"cell_id=(\S+)").alias("cell_id"))


def numbered_reads(reads: DataFrame, order: str = "id") -> DataFrame:
    """Adds ``read_id``, a counter of at least eight digits in the order of ``order``; see :func:`ranked`, so equal beginnings of ids do not matter."""
    from lymphlake.operators.order import ranked

    return ranked(reads, [F.asc(order)], "_rank").withColumn("read_id", F.format_string("%08d", "_rank")).drop("_rank")
