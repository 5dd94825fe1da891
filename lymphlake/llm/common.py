"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but these six code points.
WORD = r"[^\x20\x09-\x0D]+"


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def id_crc32(doc_id: Column) -> Column:
    """CRC-32 of an id's decimal text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null.

    Each word becomes one letter and all else goes; counting matches would
    copy the text for each of them.
    """
    letters = F.regexp_replace(F.regexp_replace(text, WORD, "w"), r"[\x20\x09-\x0D]+", "")
    return F.coalesce(F.length(letters), F.lit(0)).cast("long")


def map_text(docs: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``docs`` behind ``run``, which sees two columns: ``rest``, all others as one struct, and ``text``.

    So names of any kind pass, those with dots among them.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    boxed = docs.select(F.struct(*(rest or [F.lit(0).alias("none")])).alias("rest"), "text")
    return boxed.mapInArrow(run, boxed.schema).select(*[F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``most`` bytes a piece.

    A single longer value still forms a piece of its own, uncut. Between
    batches and at the end of a task the worker gives back what is free.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)
        del batch
        give_back()


def give_back() -> None:
    """Return free memory of Arrow's pool and of the C library to the system.

    Spark keeps workers for the tasks of later stages, several an executor, so
    what one of them once needed would stay with it.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)
