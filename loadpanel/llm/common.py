"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loadpanel.scale import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer's file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    base = scratch_dir(spark).rstrip("/")
    return f"{base}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes, a null one as no bytes."""
    return F.coalesce(F.col(column).cast("string").cast("binary"), F.lit(b""))


def lower_ascii(column: str | Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(column, UPPER, LOWER)


def give_back() -> None:
    """Returns freed memory to the system: Spark keeps a worker for the next task, often of another operator."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` has about ``limit`` bytes in each, one row at least.

    At their end, which is that of a task, memory is given back.
    """
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)
    give_back()
