"""Period returns and what is built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesframe.functions.columns import ratio
from seriesframe.functions.ordered import CHUNK, Keys, as_keys, bucketed, rolling, with_prev, with_running


def returns(
    df: DataFrame,
    by: Keys,
    dt: str,
    val: str,
    change: str = "change",
    ret: str = "daily_return",
    prev_dt: str | None = None,
) -> DataFrame:
    """Change and return against the previous row of the entity, NULL on the first row.

    Row based: a gap in the dates gives one return over the whole gap. A zero previous
    value gives a NULL return. `prev_dt` names a column for the previous row's date.
    """
    prev = {"_prev": val} | ({prev_dt: dt} if prev_dt else {})
    step = F.col(val) - F.col("_prev")
    return (
        with_prev(df, by, dt, prev).withColumns({change: step, ret: ratio(step, F.col("_prev"))}).drop("_prev")
    )


def market_daily(bars: DataFrame, ent: str = "symbol", dt: str = "date", prev_dt: str | None = None) -> DataFrame:
    """Bars with change and daily return for all entities."""
    cols = [ent, "category", dt, "open", "high", "low", "close", "volume"]
    out = [*cols, "change", "daily_return"] + ([prev_dt] if prev_dt else [])
    return returns(bars.select(*cols), ent, dt, "close", prev_dt=prev_dt).select(*out)


def category_returns(
    bars: DataFrame, category: str, ent: str = "symbol", dt: str = "date", prev_dt: str | None = None
) -> DataFrame:
    """Volume and daily return of one category; the filter is placed before the window."""
    out = [ent, dt, "volume", "daily_return"] + ([prev_dt] if prev_dt else [])
    picked = bars.filter(F.col("category") == category).select(ent, dt, "close", "volume")
    return returns(picked, ent, dt, "close", prev_dt=prev_dt).select(*out)


def rolling_vol(
    df: DataFrame, by: Keys, dt: str, ret: str = "daily_return", n: int = 20, out: str = "rolling_volatility"
) -> DataFrame:
    """Sample deviation of the last n rows' returns, once n non-NULL returns have been seen.

    The frame counts rows, the gate counts non-NULL returns up to the current row.
    """
    keys = as_keys(by)
    slim = df.select(*keys, dt, ret, *([CHUNK] if bucketed(df, keys, dt) else []))
    usable = F.when(F.col(ret).isNotNull(), 1).otherwise(0)
    placed = with_running(slim, keys, dt, {"_seen": ("sum", usable), "_pos": ("sum", F.lit(1))})
    framed = rolling(placed, keys, "_pos", n, lambda w: {"_dev": F.stddev_samp(ret).over(w)})
    return framed.select(*keys, dt, F.when(F.col("_seen") >= n, F.col("_dev")).alias(out))


def trend(df: DataFrame, by: Keys, dt: str, val: str, change: str = "change", label: str = "trend") -> DataFrame:
    """Change and direction against the previous observation.

    No previous value: `n/a`. A NULL current value after a known one: `flat`.
    """
    cur, prev = F.col(val), F.col("_prev")
    direction = (
        F.when(prev.isNull(), "n/a").when(cur > prev, "up").when(cur < prev, "down").otherwise("flat")
    )
    return with_prev(df, by, dt, {"_prev": val}).withColumns({change: cur - prev, label: direction}).drop("_prev")


def basket_vs_benchmark(
    ret: DataFrame,
    dt: str = "date",
    val: str = "daily_return",
    category: str = "category",
    basket: str = "basket",
    benchmark: str = "benchmark",
) -> DataFrame:
    """Equal-weight basket return, benchmark return and their spread per date.

    Dates only one side has stay, with a NULL spread. The basket is averaged before the
    join, so the join sees one row per date and side.
    """
    mean = ret.filter(F.col(category) == basket).groupBy(dt).agg(F.avg(val).alias("basket_return"))
    bench = ret.filter(F.col(category) == benchmark).select(dt, F.col(val).alias("benchmark_return"))
    return mean.join(bench, dt, "full_outer").select(
        dt, "basket_return", "benchmark_return", (F.col("basket_return") - F.col("benchmark_return")).alias("spread")
    )
