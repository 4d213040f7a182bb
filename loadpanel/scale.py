"""What keeps the plans whole at any size: written intermediates, joins whose
small side is measured before it is broadcast, and group-size checks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# A table is broadcast only up to this many (narrow) rows.
BROADCAST_ROWS = 100_000
# Copies of the lookup side in the salted join used beyond that bound.
SALTS = 64

# Row counts that came for free: counted while a table was written, or built here.
_ROWS: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def scratch_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, which all executors share: ``spark.checkpoint.dir``.

    In local mode, where driver and executors are one process, a temporary folder
    is named there if nothing is. On a cluster that names none this raises.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="loadpanel-"))
    return spark.conf.get("spark.checkpoint.dir")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Compute ``df`` once and continue from the stored result.

    Stored as Parquet in the shared folder: it outlives lost executors, later
    scans read only the columns they use, and no lineage is carried along.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _ROWS[out] = counted.get["rows"]
    return out


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table from Python rows."""
    out = spark.createDataFrame(list(rows), schema)
    _ROWS[out] = len(rows)
    return out


def row_bound(df: DataFrame) -> int | None:
    """Row count of a table from this module, None for any other frame.

    A count taken during a write can only be too high, after a task was rerun,
    so it is safe as an upper bound.
    """
    return _ROWS.get(df)


def is_small(table: DataFrame, max_rows: int | None = None) -> bool:
    """Whether ``table`` has at most ``max_rows`` rows; reads no more than needed."""
    bound = BROADCAST_ROWS if max_rows is None else max_rows
    known = row_bound(table)
    return (table.limit(bound + 1).count() if known is None else known) <= bound


def lookup_join(
    fact: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    spread: str,
    max_rows: int | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Inner join of a large frame with a lookup table that may not be small.

    Within the bound the table is broadcast and the fact side does not move. Beyond it, each key is split over ``SALTS`` sub-keys by a hash
    of the fact column ``spread``, so one entity with a third of all rows still
    lands in many tasks. ``table`` should be materialized or cheap: a frame of
    unknown size is read once to count it and once for the join, unless ``small``
    says what is known of it.
    """
    on = list(on)
    if is_small(table, max_rows) if small is None else small:
        return fact.join(F.broadcast(table), on)
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS).cast("long"))
    every_salt = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    copies = table.withColumn("_salt", F.explode(every_salt))
    return fact.withColumn("_salt", salt).join(copies, [*on, "_salt"]).drop("_salt")


def key_filter(fact: DataFrame, keys: DataFrame, on: Sequence[str], max_rows: int | None = None) -> DataFrame:
    """Rows of ``fact`` whose key is listed in ``keys`` (left semi join).

    A key list beyond the bound goes through a shuffle join, where adaptive
    execution splits the partitions of hot keys on the fact side.
    """
    side = F.broadcast(keys) if is_small(keys, max_rows) else keys
    return fact.join(side, list(on), "left_semi")


def groups_within(df: DataFrame, keys: Sequence[str], bound: int, total: int | None = None) -> bool:
    """Whether no group has more than ``bound`` rows.

    ``total`` is an upper bound of all rows, if one is known; only beyond it are
    the groups counted (map-side combined).
    """
    if total is not None and total <= bound:
        return True
    return (df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) <= bound
