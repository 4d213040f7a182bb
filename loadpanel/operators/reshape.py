"""Wide <-> long and union of series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from loadpanel.schema import COVARIATE_COLUMNS, KEYS


def melt(wide: DataFrame, ids: Sequence[str] = KEYS, keep_nulls: bool = False) -> DataFrame:
    """Wide covariates to (ids, feature, value); rows without a value are dropped."""
    columns = [c for c in wide.columns if c not in ids]
    long = wide.unpivot(list(ids), columns, "feature", "value")
    return long if keep_nulls else long.where(F.col("value").isNotNull())


def pivot(
    cov: DataFrame, columns: Mapping[str, str] = COVARIATE_COLUMNS, ids: Sequence[str] = KEYS
) -> DataFrame:
    """Long covariates to one column per feature (feature -> column name).

    The feature list is fixed, so no job is spent on finding it and a feature
    that is absent shows up as an all-null column for the null profile to flag.
    """
    cells = [
        F.max(F.when(F.col("feature") == feature, F.col("value"))).alias(name)
        for feature, name in columns.items()
    ]
    # Features outside the list give a row of NULLs rather than no row.
    return cov.groupBy(*ids).agg(*cells)


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name."""
    return reduce(DataFrame.unionByName, frames)
