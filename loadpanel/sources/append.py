"""Appending to a stored table without breaking its key.

Beside the table lies an index: for each file its range of times and a Bloom filter of its keys, in blocks of
32,768 bits. New keys are held against the ranges, then against one block of each file that is left, and only files
with a likely match are read to see whether a key is really there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from loadpanel.operators.quality import assert_key
from loadpanel.scale import is_small, materialize
from loadpanel.schema import KeyViolation

# Bits of a block, as Spark's bitmap functions have them, the keys meant for one, and bits set for each key: about one
# key in two thousand matches by chance.
BITS, BLOCK_KEYS, PROBES = 32_768, 2_048, 7


def _positions(h: Column) -> list[Column]:
    """Places of a key's bits in its block; each takes other bits of the hash."""
    return [F.pmod(F.xxhash64(h, F.lit(i)), F.lit(BITS).cast("long")) for i in range(PROBES)]


def _index_path(path: str) -> str:
    return f"{path.rstrip('/')}.keys"


def _file_name(path: str) -> Column:
    """The file's place inside the table."""
    return F.substring_index(F.col("_metadata.file_path"), f"{path.rstrip('/').rpartition('/')[2]}/", -1)


def _files(spark: SparkSession, path: str) -> dict[str, str]:
    """Place inside the table -> full path of every file."""
    mark = f"{path.rstrip('/').rpartition('/')[2]}/"
    return {f.rpartition(mark)[2]: f for f in spark.read.parquet(path).inputFiles()}


def _read(spark: SparkSession, path: str, files: Sequence[str]) -> DataFrame:
    """Some files of the table, with the columns that its folders name."""
    return spark.read.option("basePath", path).parquet(*files)


def _index(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(_index_path(path))
    except AnalysisException:
        return None


def index_files(spark: SparkSession, path: str, keys: Sequence[str], ts: str = "ts_utc") -> int:
    """Adds the files that the index does not know yet; how many they were.

    Also what mends the index after a run that ended between writing and indexing.
    """
    files, known = _files(spark, path), _index(spark, path)
    old = set() if known is None else {r["file"] for r in known.select("file").distinct().collect()}
    new = [full for name, full in files.items() if name not in old]
    if not new:
        return 0
    rows = _read(spark, path, new).select(_file_name(path).alias("file"), F.col(ts).alias("at"), F.xxhash64(*keys).alias("h"))
    sizes = materialize(
        rows.groupBy("file").agg(
            F.count("*").alias("n"), F.min("at").alias("first"), F.max("at").alias("last"), F.ceil(F.count("*") / BLOCK_KEYS).alias("n_blocks")
        ),
        "key-files",
    )
    blocked = rows.join(F.broadcast(sizes) if is_small(sizes) else sizes, "file")
    block = F.pmod(F.xxhash64("h", F.lit(-1)), F.col("n_blocks"))
    bits = blocked.select("file", block.alias("block"), F.explode(F.array(*_positions(F.col("h")))).alias("bit"))
    filters = bits.groupBy("file", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    filters.join(sizes, "file").write.mode("append").parquet(_index_path(path))
    return len(new)


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def _likely(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """For each list of places (``PROBES`` for each key), whether all of a key's bits are set."""
    for bits, places in batches:
        out = []
        for own, at in zip(bits, places):
            held = np.unpackbits(np.frombuffer(own, np.uint8), bitorder="little")
            out.append(held[np.asarray(at, np.int64)].reshape(-1, PROBES).all(axis=1).tolist())
        yield pd.Series(out, dtype=object)


def likely_files(new: DataFrame, index: DataFrame, keys: Sequence[str], ts: str = "ts_utc") -> DataFrame:
    """file and the keys of ``new`` that may be in it; a file whose times or filter exclude a key is left out."""
    ranges = materialize(index.groupBy("file").agg(F.first("first").alias("first"), F.first("last").alias("last"), F.first("n_blocks").alias("n_blocks")), "key-ranges")
    asked = new.select(*keys, F.col(ts).alias("_at"), F.xxhash64(*keys).alias("h"))
    # Files that no new time falls into go first: a span of times against a span of times.
    span = asked.agg(F.min("_at").alias("lo"), F.max("_at").alias("hi"))
    ranges = materialize(ranges.join(F.broadcast(span), (F.col("first") <= F.col("hi")) & (F.col("last") >= F.col("lo"))).drop("lo", "hi"), "key-near")
    near = asked.join(F.broadcast(ranges) if is_small(ranges) else ranges, F.col("_at").between(F.col("first"), F.col("last")))
    block = F.pmod(F.xxhash64("h", F.lit(-1)), F.col("n_blocks"))
    probes = near.select("file", block.alias("block"), F.struct(*keys).alias("key"), F.array(*_positions(F.col("h"))).alias("places"))
    # The keys of a block are looked up together; a block is meant for a bounded number of stored keys.
    lists = probes.groupBy("file", "block").agg(F.collect_list(F.struct("key", "places")).alias("asked"))
    found = lists.join(index.select("file", "block", "bits"), ["file", "block"])
    marked = found.select("file", "asked", _likely("bits", F.flatten(F.col("asked.places"))).alias("hit"))
    return marked.select("file", F.inline(F.arrays_zip(F.col("asked.key").alias("key"), F.col("hit").alias("hit")))).where("hit").select("file", "key.*")


def append_table(df: DataFrame, path: str, keys: Sequence[str], partition_by: str | None = None, ts: str = "ts_utc") -> list[str]:
    """Adds rows to the table at ``path``; the names of the files that had to be read for it.

    Raises ``KeyViolation`` if a key is null, occurs twice in ``df`` or is stored already; the table is then as before.
    Two runs must not append to one table at the same time.
    """
    spark = df.sparkSession
    new = assert_key(materialize(df, "appended"), keys)
    index_files(spark, path, keys, ts)
    read: list[str] = []
    likely = materialize(likely_files(new, _index(spark, path), keys, ts), "likely-keys")
    read = sorted(r["file"] for r in likely.select("file").distinct().collect())
    if read:
        files = _files(spark, path)
        stored = _read(spark, path, [files[f] for f in read])
        clashes = stored.join(likely.select(*keys), list(keys), "left_semi").select(*keys).limit(5).collect()
        if clashes:
            raise KeyViolation(f"keys {tuple(keys)} are stored already, among them {[tuple(r) for r in clashes]}")
    order = [*([partition_by] if partition_by else []), *[k for k in keys if k != partition_by]]
    writer = new.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    index_files(spark, path, keys, ts)
    return read
