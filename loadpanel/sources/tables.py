"""Stored panel tables: checked replacement, scans and the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from loadpanel.operators.quality import assert_key


def replace_table(
    df: DataFrame,
    path: str,
    keys: Sequence[str] | None = None,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = ("entity_id", "ts_utc"),
    check: Callable[[DataFrame], object] | None = None,
) -> DataFrame:
    """Replace the table at ``path`` and return it as read back.

    The new table is written beside the old one and swapped in only after its key
    and ``check`` have passed on what was written; whatever fails before leaves the
    old table. Rows are range-partitioned by the clustering columns: files hold
    consecutive rows, an entity of any size is spread over many files, and scans by
    entity or time skip files on their statistics. Partition by a column of few
    values (series or feature), never by entity.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    order = [*([partition_by] if partition_by else []), *cluster_by]
    writer = df.repartitionByRange(*order).sortWithinPartitions(*order).write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(staged)
    written = spark.read.schema(df.schema).parquet(staged).select(*df.columns)
    if keys:
        assert_key(written, keys)
    if check:
        check(written)
    _swap(spark, staged, path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    """Puts the staged folder in the place of ``path``, whichever file system they are on."""
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    new, place, old = to_path(staged), to_path(path), to_path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    had = files.exists(place)
    if had and not files.rename(place, old):
        raise OSError(f"{path} cannot be moved aside")
    if not files.rename(new, place):
        if had:
            files.rename(old, place)
        raise OSError(f"{staged} cannot be moved to {path}")
    if had:
        files.delete(old, True)


def scan_entity(df: DataFrame, entity: str) -> DataFrame:
    """Rows of one entity, in SQL with the frame as relation and the entity as bound value."""
    return df.sparkSession.sql(
        "select * from {panel} where entity_id = :entity", args={"entity": entity}, panel=df
    )


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
