"""Tables dealt into buckets by (entity, hour) when they are written, so that joins on it move no row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from loadpanel.schema import KEYS

# Buckets of a table; tables that are to be joined need the same number.
BUCKETS = 64


def store_bucketed(df: DataFrame, name: str, path: str, buckets: int = BUCKETS, by: Sequence[str] = KEYS) -> DataFrame:
    """Writes a catalogue table whose rows lie in buckets by ``by``, sorted inside, and returns it.

    An entity of any size is spread over all buckets, since the hour is part of the key. One file is written for
    each bucket. Grouping by ``by`` and joins of such tables on it need no exchange.
    """
    spark = df.sparkSession
    dealt = df.repartition(buckets, *by)
    dealt.write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(name)
    return spark.table(name)
