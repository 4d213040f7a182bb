"""Column expressions; everything here stays in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from loadpanel.session import is_utc

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a zone-less UTC timestamp.

    In a UTC session the cast to an instant changes nothing and is nearly free;
    in any other it would shift, so the difference to the epoch is taken.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    if is_utc():
        return F.unix_micros(ts.cast("timestamp"))
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.timestamp_diff("MICROSECOND", epoch, ts)


def floor_div(a: Column, b: int) -> Column:
    """Integer floor division, exact for negative ``a`` too."""
    step = F.lit(b).cast("long")
    return F.call_function("div", a - F.pmod(a, step), step)


# Sums that must not depend on the order of their terms run over millionths.
MILLION = 1_000_000


def millionths(value: Column | str) -> Column:
    """A double as a whole number of millionths, with room for values up to 1e21."""
    value = F.col(value) if isinstance(value, str) else value
    return F.rint(value * MILLION).cast("decimal(27,0)")


def wide_sum(whole: Column) -> Column:
    """Sum of whole numbers with room for any number of rows."""
    return F.sum(whole.cast("decimal(27,0)"))


def fixed_sum(value: Column | str) -> Column:
    """Order-independent sum of a double column, as a double."""
    return wide_sum(millionths(value)).cast("double") / MILLION


def local_time(ts: Column | str, zone: Column | str, known: Sequence[str] = ()) -> Column:
    """Wall clock of a UTC instant in the zone named in each row.

    Looking a zone up by name costs more than the conversion. If the zones are
    ``known``, each gets a branch in which its rules are a constant.
    """
    if not known or not is_utc():
        return F.convert_timezone(F.lit("UTC"), zone, ts)
    zone = F.col(zone) if isinstance(zone, str) else zone
    wall = F.lit(None).cast("timestamp")
    for name in known:
        wall = F.when(zone == name, F.from_utc_timestamp(ts, name)).otherwise(wall)
    return wall.cast("timestamp_ntz")


def calendar_fields(wall: Column) -> dict[str, Column]:
    """Local calendar columns; ``dayofweek`` counts from Sunday = 0."""
    sunday_first = F.dayofweek(wall)
    return {
        "hour_local": F.hour(wall).cast("long"),
        "dayofweek": (sunday_first - 1).cast("long"),
        "month_local": F.month(wall).cast("long"),
        "dayofyear": F.dayofyear(wall).cast("long"),
        "year": F.year(wall).cast("long"),
        "is_weekend": sunday_first.isin(1, 7).cast("int"),
    }


def degree_fields(temp: Column, base: float) -> dict[str, Column]:
    """Heating and cooling degrees and the squared temperature.

    ``greatest`` skips NULL, so a missing temperature reads as zero degree days;
    ``temp_sq`` stays NULL and the null profile shows it.
    """
    zero = F.lit(0.0)
    return {
        "hdd": F.greatest(zero, F.lit(float(base)) - temp),
        "cdd": F.greatest(zero, temp - F.lit(float(base))),
        "temp_sq": temp * temp,
    }


def abs_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted)


def relative_error(actual: Column, predicted: Column) -> Column:
    """|a - p| / a, NULL where a is 0."""
    return F.try_divide(F.abs(actual - predicted), actual)


def safe_corr(x: str, y: str) -> Column:
    """Pearson correlation over rows that have both; NULL for a constant side."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(a) * F.stddev_pop(b))
