"""Findings over return and attention series: curves, lags, events, concentration, cohorts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from seriesframe.functions.columns import (
    TRADING_DAYS_PER_YEAR,
    compound,
    concentration_band,
    pearson,
    ratio,
    spread_side,
    spread_width,
)
from seriesframe.functions.ordered import Keys, around, as_keys, chunk_of, with_position, with_prev, with_running
from seriesframe.functions.quantiles import exact_median
from seriesframe.operators.panels import share
from seriesframe.sources.workspace import written


# --- cumulative curves -------------------------------------------------------------------


def cumulative(df: DataFrame, dt: str, curves: Mapping[str, str], by: Keys = None) -> DataFrame:
    """Running compound return of every curve over the rows where all of them are known.

    `curves` maps return column -> name of its cumulative column.
    """
    whole = df.na.drop(subset=list(curves))
    grown = with_running(whole, by, dt, {f"_g_{out}": ("product", 1 + F.col(c)) for c, out in curves.items()})
    return grown.withColumns({out: F.col(f"_g_{out}") - 1 for out in curves.values()}).drop(
        *[f"_g_{out}" for out in curves.values()]
    )


def spread_totals(df: DataFrame, dt: str, left: str, right: str) -> DataFrame:
    """Total compound return of two series over their common dates, in percent, and the spread."""
    totals = df.na.drop(subset=[left, right]).agg(
        (compound(F.col(left)) * 100).alias("left_total_pct"),
        (compound(F.col(right)) * 100).alias("right_total_pct"),
        F.min(dt).alias("start_date"),
        F.max(dt).alias("end_date"),
    )
    spread = F.col("left_total_pct") - F.col("right_total_pct")
    return totals.withColumns(
        {"spread_pts": spread, "side": spread_side(spread), "width": spread_width(spread)}
    )


# --- attention: change, spikes, lags, events ----------------------------------------------


def total_change(df: DataFrame, dt: str, val: str, change: str = "pct_change") -> DataFrame:
    """Sum over entities per date and its relative change from the date before."""
    daily = df.groupBy(dt).agg(F.sum(val).alias(val))
    return (
        with_prev(daily, None, dt, {"_prev": val})
        .withColumn(change, ratio(F.col(val) - F.col("_prev"), F.col("_prev").cast("double")))
        .drop("_prev")
    )


def top_spikes(df: DataFrame, dt: str, change: str, n: int = 5, by: Keys = None) -> DataFrame:
    """The n largest changes, of the frame or of each entity; of equal ones the earlier."""
    known, order = df.filter(F.col(change).isNotNull()), [F.col(change).desc(), F.col(dt)]
    if not as_keys(by):
        return known.orderBy(*order).limit(n)
    place = F.row_number().over(Window.partitionBy(*as_keys(by)).orderBy(*order))
    return known.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def _on_common_dates(x: DataFrame, y: DataFrame, dt: str, x_val: str, y_val: str, keys: list[str]) -> DataFrame:
    """keys, dt, _x, _y: a row for every date that an entity's x or y has. A side without the keys belongs to every entity."""

    def of(df: DataFrame, val: str, other: DataFrame) -> DataFrame:
        rows = df.select(*[k for k in keys if k in df.columns], dt, F.col(val).cast("double").alias("_v"))
        if all(k in df.columns for k in keys):
            return rows
        # one array for each calendar chunk of the shared series, which has one row per date
        chunks = rows.groupBy(chunk_of(rows, dt).alias("_c")).agg(F.collect_list(F.struct(dt, "_v")).alias("_rows"))
        chunks = written(chunks, "shared-series")
        every = chunks.agg(F.collect_set("_c").alias("_all")).scalar()
        entities = other.select(*keys).distinct().withColumn("_c", F.explode(every))
        return entities.join(F.broadcast(chunks), "_c").select(*keys, F.inline("_rows"))

    left, right = of(x, x_val, y), of(y, y_val, x)
    none = F.lit(None).cast("double")
    both = left.withColumns({"_x": F.col("_v"), "_y": none}).unionByName(right.withColumns({"_x": none, "_y": F.col("_v")}))
    return both.groupBy(*keys, dt).agg(F.max("_x").alias("_x"), F.max("_y").alias("_y"))


def lag_corr(
    x: DataFrame,
    y: DataFrame,
    dt: str,
    x_val: str,
    y_val: str,
    lags: Sequence[int] = range(-10, 11),
    by: Keys = None,
) -> DataFrame:
    """Correlation of x at position i with y at position i + k for every lag k, for one pair of series or per entity.

    Frames have one row per (entity and) date; one without the columns of `by` is compared with every entity of the
    other. Positions count the union of both series' dates. A lag with fewer than three complete pairs, or a constant
    side, has a NULL correlation. All lags are read off neighbouring rows in blocks of positions, so an entity with many
    rows is spread and no row is sent once per lag.
    """
    keys, lags = as_keys(by), [int(k) for k in lags]
    merged = written(_on_common_dates(x, y, dt, x_val, y_val, keys), "common-dates")
    placed = with_position(merged, keys, dt, "_pos")
    back, ahead = max(0, -min(lags)), max(0, max(lags))
    ahead_by = {f"_y{i}": k for i, k in enumerate(lags)}
    met = around(placed, keys, "_pos", back, ahead, lambda w: {c: F.lead("_y", k).over(w) for c, k in ahead_by.items()})
    # one row per lag only for the partial aggregate of the same task
    each = F.inline(F.array(*[F.struct(F.lit(k).alias("lag"), F.col(c).alias("_at")) for c, k in ahead_by.items()]))
    return met.select(*keys, "_x", each).groupBy(*keys, "lag").agg(
        pearson(F.col("_x"), F.col("_at")).alias("correlation"),
        F.count_if(F.col("_x").isNotNull() & F.col("_at").isNotNull()).alias("n_pairs"),
    )


def best_lag(scan: DataFrame, by: Keys = None) -> DataFrame:
    """Lag with the largest |r| (the smallest lag of equals) and the rough noise threshold, per entity of a keyed scan."""
    keys = as_keys(by)
    known = F.col("correlation").isNotNull()
    strength = F.when(known, F.struct(F.abs("correlation"), -F.col("lag")))
    best = F.max_by(F.struct("lag", "correlation", "n_pairs"), strength)
    return scan.groupBy(*keys).agg(
        best.alias("_b"), ratio(F.lit(2.0), F.sqrt(F.avg("n_pairs"))).alias("threshold")
    ).select(
        *keys,
        F.col("_b.lag").alias("best_lag"),
        F.col("_b.correlation").alias("best_corr"),
        F.col("_b.n_pairs").alias("n_pairs"),
        "threshold",
        (F.abs("_b.correlation") >= F.col("threshold")).alias("above_noise"),
    )


def event_study(
    events: DataFrame,
    axis: DataFrame,
    ret: DataFrame,
    dt: str,
    change: str,
    ret_val: str,
    window: int = 10,
    by: Keys = None,
) -> DataFrame:
    """Compound return in the `window` positions before and after each event, in percent, for one series or per entity.

    Positions count the dates of `axis` (one row per entity and date); returns are looked up by date, per entity where
    `ret` has its columns. Sides without a usable return give 0.0 with a count of 0. Returns are compounded over
    neighbouring rows in blocks of positions, so an entity with many rows is spread.
    """
    keys = as_keys(by)
    known = ret.select(*[k for k in keys if k in ret.columns], dt, F.col(ret_val).alias("_r"))
    line = axis.select(*keys, dt).join(known, [c for c in [*keys, dt] if c in known.columns], "left")
    placed = with_position(written(line, "event-axis"), keys, dt, "_pos")

    def sides(w: WindowSpec) -> dict[str, Column]:
        before, after = w.rowsBetween(-window, -1), w.rowsBetween(1, window)
        return {
            "return_before_pct": F.coalesce(F.product(1 + F.col("_r")).over(before) - 1, F.lit(0.0)) * 100,
            "n_before": F.count("_r").over(before),
            "return_after_pct": F.coalesce(F.product(1 + F.col("_r")).over(after) - 1, F.lit(0.0)) * 100,
            "n_after": F.count("_r").over(after),
        }

    seen = around(placed, keys, "_pos", window, window, sides)
    return events.select(*keys, dt, change).distinct().join(seen, [*keys, dt]).select(
        *keys,
        F.col(dt).alias("spike_date"),
        (F.col(change) * 100).alias("spike_size_pct"),
        "return_before_pct",
        "n_before",
        "return_after_pct",
        "n_after",
    )


def event_summary(study: DataFrame) -> DataFrame:
    means = study.agg(
        F.avg("return_before_pct").alias("return_before_pct"), F.avg("return_after_pct").alias("return_after_pct")
    )
    return means.withColumn("gap_pts", F.col("return_after_pct") - F.col("return_before_pct"))


# --- concentration --------------------------------------------------------------------------


def entity_shares(df: DataFrame, ent: str, val: str, round_to: int | None = None) -> DataFrame:
    """Sum and share of the total per entity in percent, in no order."""
    sums = written(df.filter(F.col(val).isNotNull()).groupBy(ent).agg(F.sum(val).alias(val)), "entity-sums")
    shares = share(sums, val)
    return shares if round_to is None else shares.withColumn("share_pct", F.round("share_pct", round_to))


def volume_share(df: DataFrame, ent: str, val: str, round_to: int | None = 1) -> DataFrame:
    """`entity_shares`, largest first."""
    return entity_shares(df, ent, val, round_to).orderBy(F.col("share_pct").desc(), ent)


def cohort(df: DataFrame, ent: str, members: Mapping[str, Sequence[str]] | DataFrame, out: str = "cohort") -> DataFrame:
    """Rows of the cohorts' members, labelled; an entity in several cohorts appears in each.

    Member lists become one expression, without a join; a dimension frame is joined.
    """
    if isinstance(members, DataFrame):
        return df.join(members.select(ent, out), ent)
    labels = F.array(*[F.when(F.col(ent).isin(list(m)), F.lit(name)) for name, m in members.items()])
    return df.withColumn(out, F.explode(F.filter(labels, lambda c: c.isNotNull())))


def concentration(df: DataFrame, ent: str, val: str, round_shares: int | None = None) -> DataFrame:
    """Herfindahl index of the shares, effective count, band, and the top entity's standing.

    Shares are unrounded unless `round_shares` gives the places they are rounded to first.
    """
    shares = entity_shares(df, ent, val, round_shares).select(ent, "share_pct")
    measures = shares.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("share_pct") * F.col("share_pct")).alias("hhi"),
        F.min_by(F.struct(ent, "share_pct"), F.struct(-F.col("share_pct"), F.col(ent))).alias("_top"),
    )
    second = shares.orderBy(F.col("share_pct").desc(), ent).limit(2).agg(
        F.when(F.count(F.lit(1)) == 2, F.min("share_pct")).alias("s")
    )
    top, rest = F.col("top_share_pct"), F.col("rest_share_pct")
    return (
        measures.select(
            "n",
            "hhi",
            F.col(f"_top.{ent}").alias("top_entity"),
            F.col("_top.share_pct").alias("top_share_pct"),
            second.scalar().alias("second_share_pct"),
        )
        .withColumns(
            {
                "effective_n": ratio(F.lit(10000.0), F.col("hhi")),
                "band": concentration_band(F.col("hhi")),
                "fair_share_pct": ratio(F.lit(100.0), F.col("n").cast("double")),
                "rest_share_pct": 100 - top,
            }
        )
        .withColumns(
            {
                "top_vs_fair": ratio(top, F.col("fair_share_pct")),
                "top_vs_second": ratio(top, F.col("second_share_pct")),
                "top_vs_rest": F.when(top > rest, "more than the rest")
                .when(top >= rest * 0.8, "nearly the rest")
                .otherwise("clear minority"),
            }
        )
    )


# --- conditional returns ---------------------------------------------------------------------


def direction(df: DataFrame, dt: str, val: str, out: str = "direction") -> DataFrame:
    """rising / falling per date from the step to it; no step or a NULL gives no label."""
    step = F.col(val) - F.col("_prev")
    label = F.when(step > 0, "rising").when(step < 0, "falling")
    return with_prev(df.select(dt, val), None, dt, {"_prev": val}).select(dt, label.alias(out))


def conditional_return(
    ret: DataFrame, labels: DataFrame, ent: str, dt: str, val: str, label: str = "direction", places: int = 2
) -> DataFrame:
    """Compound return per entity over rising days and over falling days, in percent.

    Labels have one row per date. Days without a label are left out.
    """
    days = ret.filter(F.col(val).isNotNull()).join(labels.filter(F.col(label).isNotNull()).select(dt, label), dt)

    def side(name: str):
        return F.round(compound(F.when(F.col(label) == name, F.col(val))) * 100, places).alias(name)

    return days.groupBy(ent).agg(side("rising"), side("falling"))


def sensitivity_board(sensitivity: DataFrame, ent: str) -> DataFrame:
    """Conditional returns, worst on rising days first."""
    return sensitivity.orderBy(F.col("rising").asc_nulls_last(), ent)


def exceptions(sensitivity: DataFrame) -> DataFrame:
    """Entities that did better on rising days."""
    return sensitivity.filter(F.col("rising") > F.col("falling"))


def exception_counts(sensitivity: DataFrame) -> DataFrame:
    """Exceptions and the others; an entity with only one kind of day is one of the others."""
    counts = sensitivity.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("rising") > F.col("falling")).alias("exceptions")
    )
    return counts.withColumn("typical", F.col("total") - F.col("exceptions"))


# --- series extremes and cohorts -----------------------------------------------------------------


def extremes(df: DataFrame, dt: str, val: str, by: Keys = None) -> DataFrame:
    """First, latest, highest and lowest known value with their dates, mean, and max / mean.

    Of equal values the earliest date counts.
    """
    keys = as_keys(by)
    v, day = F.col(val), F.unix_date(dt)
    return (
        df.filter(v.isNotNull())
        .groupBy(*keys)
        .agg(
            F.min(dt).alias("first_date"),
            F.min_by(val, dt).alias("first_value"),
            F.max(dt).alias("latest_date"),
            F.max_by(val, dt).alias("latest_value"),
            F.max_by(dt, F.struct(v, -day)).alias("max_date"),
            F.max(val).alias("max_value"),
            F.min_by(dt, F.struct(v, day)).alias("min_date"),
            F.min(val).alias("min_value"),
            F.avg(val).alias("mean_value"),
        )
        .withColumn("max_to_mean", ratio(F.col("max_value"), F.col("mean_value")))
    )


def cohort_days(members: DataFrame, dt: str, val: str, group: str = "cohort") -> DataFrame:
    """Equal-weight mean return per cohort and date over the members with data that day."""
    return members.filter(F.col(val).isNotNull()).groupBy(group, dt).agg(F.avg(val).alias("mean_return"))


def cohort_curve(members: DataFrame, dt: str, val: str, group: str = "cohort") -> DataFrame:
    """Cumulative equal-weight return per cohort and date."""
    return cumulative(cohort_days(members, dt, val, group), dt, {"mean_return": "cumulative"}, group)


def total_returns(df: DataFrame, by: Keys, val: str, out: str = "total_return_pct") -> DataFrame:
    """Compound return per entity over the whole history, in percent, in no order."""
    return df.filter(F.col(val).isNotNull()).groupBy(*as_keys(by)).agg((compound(F.col(val)) * 100).alias(out))


def total_return_by(df: DataFrame, by: Keys, val: str, out: str = "total_return_pct") -> DataFrame:
    """`total_returns`, best first."""
    return total_returns(df, by, val, out).orderBy(F.col(out).desc(), *as_keys(by))


def cohort_summary(members: DataFrame, ent: str, dt: str, val: str, group: str = "cohort") -> DataFrame:
    """Per cohort: final return, annualised volatility, members, losers, median and worst member."""
    whole = cohort_days(members, dt, val, group).groupBy(group).agg(
        (compound(F.col("mean_return")) * 100).alias("final_return_pct"),
        (F.stddev_samp("mean_return") * F.sqrt(F.lit(float(TRADING_DAYS_PER_YEAR)))).alias("annual_vol"),
    )
    each = written(total_returns(members, [group, ent], val, "_total"), "member-returns")
    parts = each.groupBy(group).agg(
        F.count(F.lit(1)).alias("members"),
        F.count_if(F.col("_total") < 0).alias("negative_members"),
        F.min_by(ent, F.struct("_total", ent)).alias("worst_member"),
        F.min("_total").alias("worst_return_pct"),
    )
    return whole.join(parts, group).join(exact_median(each, group, "_total", "median_return_pct"), group)


def cohort_gap(summary: DataFrame, left: str, right: str, group: str = "cohort") -> DataFrame:
    """Final returns of two cohorts, their gap, and the ratio of their volatilities."""

    def of(name: str, col: str):
        return F.max(F.when(F.col(group) == name, F.col(col)))

    return summary.agg(
        of(left, "final_return_pct").alias("left_final_pct"),
        of(right, "final_return_pct").alias("right_final_pct"),
        (of(left, "final_return_pct") - of(right, "final_return_pct")).alias("gap_pts"),
        ratio(of(left, "annual_vol"), of(right, "annual_vol")).alias("vol_ratio"),
        of(left, "negative_members").alias("negative_members"),
    )


def coverage(inputs: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(input, latest date, known values) for every named (frame, date column, value column)."""
    rows = None
    for name, (df, dt, val) in inputs.items():
        one = df.agg(F.lit(name).alias("input"), F.max(dt).alias("latest_date"), F.count(val).alias("known_values"))
        rows = one if rows is None else rows.unionByName(one)
    return rows
