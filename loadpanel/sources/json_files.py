"""The two raw JSON shapes and their one canonical long form.

Row-wise: an array of objects, one per hour. Columnar: one object whose
``hourly`` member holds aligned lists; the entity is only in the file name.
A JSON document is read whole by one task, so parallelism comes from the number
of files. Neither parser groups rows: the first shuffle downstream spreads them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Record members, time formats and the file name of each shape.
ROW_SCHEMA = "period string, respondent string, type string, value string"
ROW_TIME = "yyyy-MM-dd'T'HH"
COLUMN_TIME = "yyyy-MM-dd'T'HH:mm"
COLUMN_FILE = r"([^/]+)_weather\.json"


def canonical_rows(records: DataFrame) -> DataFrame:
    """Records to (entity_id, ts_utc, series_type, value).

    ``period`` is UTC and ``value`` a numeric string; text that is no number
    raises, a null stays null and NaN becomes null.
    """
    number = F.col("value").cast("double")
    return records.select(
        F.col("respondent").alias("entity_id"),
        F.to_timestamp_ntz("period", F.lit(ROW_TIME)).alias("ts_utc"),
        F.col("type").alias("series_type"),
        F.when(~F.isnan(number), number).alias("value"),
    )


def read_rowwise(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All row-wise files under the paths as one observation table."""
    reader = spark.read.schema(ROW_SCHEMA).option("multiLine", True).option("mode", "FAILFAST")
    return canonical_rows(reader.json(paths if isinstance(paths, str) else list(paths)))


def parse_rowwise(documents: DataFrame, body: str = "body") -> DataFrame:
    """The same from a column of JSON texts, one array of objects per row."""
    parsed = F.from_json(F.col(body), f"array<struct<{_fields(ROW_SCHEMA)}>>", {"mode": "FAILFAST"})
    return canonical_rows(documents.select(F.inline(parsed)))


def read_columnar(
    spark: SparkSession,
    path: str,
    features: Sequence[str] | None = None,
    file_pattern: str = COLUMN_FILE,
) -> DataFrame:
    """All columnar files under the path as one long covariate table."""
    texts = spark.read.text(path, wholetext=True)
    named = texts.select(F.col("value").alias("body"), F.col("_metadata.file_name").alias("file_name"))
    return parse_columnar(named, "body", "file_name", features, file_pattern)


def parse_columnar(
    documents: DataFrame,
    body: str = "body",
    file_name: str = "file_name",
    features: Sequence[str] | None = None,
    file_pattern: str = COLUMN_FILE,
) -> DataFrame:
    """Columnar JSON texts to (entity_id, ts_utc, feature, value), nulls and NaN dropped.

    Every list beside ``time`` is a feature, unless ``features`` names the wanted
    ones. A file name that does not match the pattern raises.
    """
    entity = F.regexp_extract(F.col(file_name), file_pattern, 1)
    unnamed = F.raise_error(F.concat(F.lit("no entity in the file name "), F.coalesce(file_name, F.lit("NULL"))))
    # Parsed in a step of its own, so that each text is parsed once and not once per
    # list. Numbers stay text until the lists are taken apart, as ``time`` is text.
    parsed = documents.select(
        F.when(entity != "", entity).otherwise(unnamed.cast("string")).alias("entity_id"),
        F.from_json(F.col(body), "hourly map<string, array<string>>", {"mode": "FAILFAST"})["hourly"].alias("hourly"),
    )
    lists = F.map_filter("hourly", lambda name, _: name != "time")
    if features is not None:
        lists = F.map_filter(lists, lambda name, _: name.isin(*features))
    series = parsed.select("entity_id", F.col("hourly")["time"].alias("time"), F.explode(lists).alias("feature", "value"))
    rows = series.select("entity_id", "feature", F.inline(F.arrays_zip("time", "value")))
    # A bare NaN comes out of the parser in quotes.
    number = F.btrim("value", F.lit('"')).cast("double")
    return rows.select(
        "entity_id", _hour("time").alias("ts_utc"), "feature", F.when(~F.isnan(number), number).alias("value")
    ).where(F.col("value").isNotNull())


def _hour(time: str) -> Column:
    return F.to_timestamp_ntz(time, F.lit(COLUMN_TIME))


def _fields(ddl: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (part.split() for part in ddl.split(", ")))


