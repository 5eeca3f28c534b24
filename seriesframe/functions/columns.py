"""Column-level rules: typing, missing markers, labels, classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Annualisation factor and concentration thresholds.
TRADING_DAYS_PER_YEAR = 252
HHI_HIGH = 2500
HHI_MODERATE = 1500


def null_marker(col: str | Column, marker: str = ".", to: str = "double") -> Column:
    """The source's missing marker becomes NULL, anything else is cast."""
    text = F.col(col) if isinstance(col, str) else col
    return F.nullif(text, F.lit(marker)).try_cast(to)


def compact_date(col: str | Column) -> Column:
    """`yyyyMMdd...` text to a date; what follows the first eight digits is ignored."""
    text = F.col(col) if isinstance(col, str) else col
    return F.to_date(F.substring(text, 1, 8), "yyyyMMdd")


def spaced_label(col: str | Column) -> Column:
    text = F.col(col) if isinstance(col, str) else col
    return F.translate(text, "_", " ")


def short_label(col: str | Column) -> Column:
    """The part after the first slash (`owner/name` -> `name`)."""
    text = F.col(col) if isinstance(col, str) else col
    return F.split_part(text, F.lit("/"), F.lit(2))


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL for a zero denominator (plain division raises under ANSI)."""
    return num / F.nullif(den, F.lit(0).cast("double"))


def compound(ret: Column) -> Column:
    """Aggregate: product of (1 + r) minus 1; NULL returns are skipped."""
    return F.product(1 + ret) - 1


def pearson(x: Column, y: Column, min_pairs: int = 3) -> Column:
    """Aggregate: correlation of complete pairs, NULL for a constant side or too few pairs.

    `corr` raises on a constant column under ANSI, so it is put together from the moments.
    """
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    r = F.covar_pop(px, py) / F.nullif(F.stddev_pop(px) * F.stddev_pop(py), F.lit(0.0))
    return F.when(F.count_if(both) >= min_pairs, r)


def concentration_band(hhi: Column) -> Column:
    return (
        F.when(hhi > HHI_HIGH, "highly concentrated")
        .when(hhi > HHI_MODERATE, "moderately concentrated")
        .otherwise("unconcentrated")
    )


def spread_side(spread: Column) -> Column:
    return F.when(spread > 0, "outperformed").otherwise("underperformed")


def spread_width(points: Column, wide_at: float = 5.0) -> Column:
    return F.when(F.abs(points) >= wide_at, "wide").otherwise("narrow")


def member_of(col: str | Column, groups: Mapping[str, Sequence[str]], default: str | None) -> Column:
    """Name of the first group whose list holds the value, else the default."""
    value = F.col(col) if isinstance(col, str) else col
    expr = F.lit(default)
    for name, members in reversed(list(groups.items())):
        expr = F.when(value.isin(list(members)), F.lit(name)).otherwise(expr)
    return expr


def _floating(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def _is_nonfinite(name: str) -> Column:
    c = F.col(f"`{name}`")
    return F.isnan(c) | (F.abs(c) == F.lit(float("inf")))


def null_nonfinite(df: DataFrame) -> DataFrame:
    """NaN and infinities become NULL in every floating column."""
    return df.withColumns({n: F.when(~_is_nonfinite(n), F.col(f"`{n}`")) for n in _floating(df)})


def require_finite(df: DataFrame) -> DataFrame:
    """Fail the job that reads this frame if a non-finite number is left in it."""
    guard = {
        n: F.when(_is_nonfinite(n), F.raise_error(F.lit(f"non-finite value in {n}")).cast("double"))
        .otherwise(F.col(f"`{n}`"))
        for n in _floating(df)
    }
    return df.withColumns(guard)


def round_cols(df: DataFrame, cols: Sequence[str], places: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in cols})


def utc_date(ts: Column | str) -> Column:
    """Calendar day in UTC, whatever the session's zone; a time without a zone is taken as UTC."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    day = F.floor(F.unix_seconds(ts.cast("timestamp")) / 86400).cast("int")
    return F.when(F.typeof(ts) == "timestamp", F.date_from_unix_date(day)).otherwise(F.to_date(ts))


def utc_hour(ts: Column | str) -> Column:
    """Hour of the day in UTC, whatever the session's zone; a time without a zone is taken as UTC."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    hour = F.floor(F.pmod(F.unix_seconds(ts.cast("timestamp")), F.lit(86400)) / 3600).cast("int")
    return F.when(F.typeof(ts) == "timestamp", hour).otherwise(F.hour(ts))
