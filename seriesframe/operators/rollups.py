"""Kept summaries of dyadic runs of days, from which any trailing window is merged.

A run of level k is 2**k days that begin at a multiple of 2**k (days since 1970). Of the runs that hold the same days
of an entity the longest is kept, so an entity with n days has less than 2 n rows however far apart these are, and
every single day is among them. A window of any length is a union of at most two runs per level, so it is answered
from some twenty rows per entity instead of its history. Rows are partitioned by level and the year a run begins in,
and only the partitions that the asked windows need are read: of short runs, those at the ends. Beyond an entity's first
and last day a window is taken as far as the runs of the highest level go, so a window over everything reads these alone.
The day of a first or last known value, `<name>_on`, is kept only where it is not the run's own first or last day.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesframe.functions.ordered import Keys, as_keys
from seriesframe.operators.panels import span_days
from seriesframe.sources.tables import nullable

#: Levels above the days; runs of the highest one are 2**13 days, some 22 years.
TOP = 13
LEVEL, RUN, PART = "level", "run", "part"
YEARS = 100_000
#: Daily rows that a task sums up.
TASK_ROWS = 500_000


@dataclass(frozen=True)
class Measure:
    """What is kept of a column: sum, count, growth (product of 1 + it), min, max, first or last known value."""

    kind: str
    col: str


_PLAIN: dict[str, tuple[Callable, Callable]] = {
    "sum": (F.sum, F.sum),
    "count": (F.count, F.sum),
    "growth": (lambda c: F.product(1 + F.col(c)), F.product),
    "min": (F.min, F.min),
    "max": (F.max, F.max),
}


_EDGES: dict[str, tuple[Callable, Callable, str]] = {
    "first": (F.min_by, F.min, "first_day"),
    "last": (F.max_by, F.max, "last_day"),
}


def _from_rows(measures: Mapping[str, Measure], dt: str) -> list[Column]:
    out = [F.min(dt).alias("first_day"), F.max(dt).alias("last_day")]
    for name, m in measures.items():
        if m.kind in _PLAIN:
            out.append(_PLAIN[m.kind][0](m.col).alias(name))
            continue
        pick, bound, _ = _EDGES[m.kind]
        known = F.when(F.col(m.col).isNotNull(), F.col(dt))
        out += [pick(m.col, known).alias(name), F.nullif(bound(known), bound(dt)).alias(f"{name}_on")]
    return out


def _merged(measures: Mapping[str, Measure], whole: bool = False) -> list[Column]:
    """The summaries of several runs as one; with `whole` the days of known values are all given."""
    out = [F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")]
    for name, m in measures.items():
        if m.kind in _PLAIN:
            out.append(_PLAIN[m.kind][1](name).alias(name))
            continue
        pick, bound, end = _EDGES[m.kind]
        known = F.when(F.col(name).isNotNull(), F.coalesce(f"{name}_on", end))
        day = bound(known) if whole else F.nullif(bound(known), bound(end))
        out += [pick(name, known).alias(name), day.alias(f"{name}_on")]
    return out


def _part(level: Column, run: Column) -> Column:
    """Partition of a run: its level and the year it begins in."""
    first = F.date_from_unix_date(F.call_function("shiftleft", run, level).cast("int"))
    return (level * YEARS + F.year(first)).cast("int")


def _days(df: DataFrame, keys: Sequence[str], dt: str, measures: Mapping[str, Measure]) -> DataFrame:
    """The summaries of single days; run is the day."""
    return df.filter(F.col(dt).isNotNull()).groupBy(*keys, F.unix_date(dt).alias(RUN)).agg(*_from_rows(measures, dt))


def _rows_as_days(df: DataFrame, keys: Sequence[str], dt: str, measures: Mapping[str, Measure], top: int) -> DataFrame:
    """Each dated row as the summary of a day, where `_longest_runs` takes it; rows travel once, with the needed columns.

    Tasks are so many that none has to spill, which is told from the number of rows.
    """
    types = {f.name: f.dataType for f in _days(df, keys, dt, measures).schema.fields}
    needed = dict.fromkeys([*keys, dt, *(m.col for m in measures.values())])
    dated = df.filter(F.col(dt).isNotNull()).select(*needed, F.shiftright(F.unix_date(dt), top).alias("_span"))
    dated = dated.repartition(1 + df.count() // TASK_ROWS, *keys, "_span")
    out = {"first_day": F.col(dt), "last_day": F.col(dt)}
    for name, m in measures.items():
        val = F.col(m.col)
        out[name] = {"growth": 1 + val, "count": F.when(val.isNotNull(), 1).otherwise(0)}.get(m.kind, val)
        if m.kind in _EDGES:
            out[f"{name}_on"] = F.lit(None)
    return dated.select(*keys, "_span", F.unix_date(dt).alias(RUN), *(c.cast(types[name]).alias(name) for name, c in out.items()))


def _right(col: Column, bits: Column) -> Column:
    return F.call_function("shiftright", col, bits)


def _longest_runs(days: DataFrame, keys: Sequence[str], measures: Mapping[str, Measure], top: int) -> DataFrame:
    """The runs that are kept: those whose other half of the next level has days as well, and all of the highest level.
    A day may have several rows in `days`.

    A day is summed from the level on at which a neighbour joins it. Everything happens per (entity, run of the highest
    level), at most 2**top days, to which the days are shuffled once, unless they bring its `_span` and lie there.
    """
    summaries = [c for c in days.columns if c not in (*keys, RUN, "_span")]
    in_order = Window.partitionBy(*keys, "_span").orderBy(RUN)
    span = F.lit(1 << top)  # a day of another span stands for no neighbour
    before = F.coalesce(F.lag(RUN).over(in_order), F.col(RUN) - span)
    beside = {"_prev": before, "_next": F.coalesce(F.lead(RUN).over(in_order), F.col(RUN) + span)}
    alone = [F.length(F.bin(F.col(RUN).bitwiseXOR(F.col(c)))) - 1 for c in beside]  # highest level without that neighbour
    levels = F.explode(F.sequence(F.least(*alone, F.lit(top)), F.lit(top))).alias(LEVEL)
    placed = (days if "_span" in days.columns else days.withColumn("_span", F.shiftright(RUN, top))).withColumns(beside)
    runs = placed.select("*", levels).withColumn(RUN, _right(F.col(RUN), F.col(LEVEL)))
    rolled = runs.groupBy(*keys, "_span", LEVEL, RUN).agg(*_merged(measures), F.min("_prev").alias("_prev"), F.max("_next").alias("_next"))
    whole, up = F.shiftright(RUN, 1), F.col(LEVEL) + 1
    kept = (F.col(LEVEL) == top) | (_right(F.col("_prev"), up) == whole) | (_right(F.col("_next"), up) == whole)
    return rolled.filter(kept).select(LEVEL, RUN, *keys, *summaries, _part(F.col(LEVEL), F.col(RUN)).alias(PART))


def roll_up(df: DataFrame, by: Keys, dt: str, measures: Mapping[str, Measure], top: int = TOP, daily: bool = False) -> DataFrame:
    """level, run, part, the entity and its summaries, for the longest runs from single days to 2**top of them.

    `daily` says that `df` is a table with about a row a day and entity: the rows then travel once, as they are. Else rows
    that share days are summed by day before they travel, and the days travel once more.
    """
    keys = as_keys(by)
    days = _rows_as_days(df, keys, dt, measures, top) if daily else _days(df, keys, dt, measures)
    return _longest_runs(days, keys, measures, top)


def write_rollups(rolled: DataFrame, target: str, gather: bool = True) -> DataFrame:
    """Keep the summaries under a path and return them as read back.

    Without `gather` every task writes its own rows of each partition: many summaries are not shuffled once more to
    have few files in each.
    """
    laid_out = (rolled.hint("rebalance", PART) if gather else rolled).sortWithinPartitions(PART, RUN)
    writer = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    writer.partitionBy(PART).parquet(target)
    return read_rollups(rolled.sparkSession, target, rolled)


def read_rollups(spark: SparkSession, target: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(nullable(like.schema)).parquet(target)


def refresh_rollups(
    spark: SparkSession, target: str, df: DataFrame, changed: DataFrame, by: Keys, dt: str, measures: Mapping[str, Measure], top: int = TOP
) -> DataFrame:
    """Bring kept summaries up to date with `df` after the (entity, date) rows of `changed` were added or replaced.

    Only the partitions that hold a changed run are written again; a run is summed anew from the kept single days,
    and from rows only where a day changed. A driver lost while the partitions move may leave some out; the
    summaries are then written again from the rows.
    """
    keys = as_keys(by)
    old = spark.read.parquet(target)
    days = changed.select(*keys, dt).distinct()
    fresh = _days(df.join(days, [*keys, dt], "left_semi"), keys, dt, measures)
    spans = days.select(*keys, F.shiftright(F.unix_date(dt), top).alias("_span")).distinct()
    single = old.filter("first_day = last_day").withColumn(RUN, F.unix_date("first_day")).drop(LEVEL, PART)
    base = single.join(fresh.select(*keys, RUN), [*keys, RUN], "left_anti").unionByName(fresh)
    base = base.withColumn("_span", F.shiftright(RUN, top)).join(spans, [*keys, "_span"], "left_semi").drop("_span")
    # a run changes with its days, and is kept from when its other half has some; no kept run is ever left out again
    levels = F.explode(F.sequence(F.lit(0), F.lit(top))).alias(LEVEL)
    touched = days.filter(F.col(dt).isNotNull()).select(*keys, F.unix_date(dt).alias(RUN), levels)
    touched = touched.withColumn(RUN, _right(F.col(RUN), F.col(LEVEL)))
    touched = touched.withColumn(RUN, F.explode(F.array(F.col(RUN), F.col(RUN).bitwiseXOR(F.lit(1))))).distinct()
    again = _longest_runs(base, keys, measures, top).join(touched, [*keys, LEVEL, RUN], "left_semi").select(*old.columns)
    parts = again.select(PART).distinct()
    kept = old.join(F.broadcast(parts), PART, "left_semi").join(again.select(LEVEL, RUN, *keys), [LEVEL, RUN, *keys], "left_anti")
    merged = kept.select(*old.columns).unionByName(again)
    writer = merged.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "zstd").partitionBy(PART).parquet(target)
    return spark.read.schema(old.schema).parquet(target)


def runs_of(first: Column, last: Column, top: int = TOP) -> Column:
    """The fewest runs (level, run) that make up the days from `first` to `last`."""
    a, b = F.unix_date(first), F.unix_date(last)

    def inside(k: int) -> tuple[Column, Column]:
        """The runs of level k that lie in the window."""
        return F.shiftright(a + F.lit((1 << k) - 1), k), F.shiftright(b + 1, k) - 1

    def alone(k: int) -> Callable[[Column], Column]:
        """Whether the run of the next level that a run is half of sticks out of the window."""
        low, high = inside(k + 1)
        return lambda run: (F.shiftright(run, 1) < low) | (F.shiftright(run, 1) > high)

    def named(k: int) -> Callable[[Column], Column]:
        return lambda run: F.struct(F.lit(k).alias(LEVEL), run.alias(RUN))

    found = []
    for k in range(top + 1):
        low, high = inside(k)
        none = F.array().cast("array<int>")
        if k == top:
            picked = F.when(low <= high, F.sequence(low, high)).otherwise(none)
        else:
            picked = F.filter(F.when(low <= high, F.array_distinct(F.array(low, high))).otherwise(none), alone(k))
        found.append(F.transform(picked, named(k)))
    return F.concat(*found)


def over_windows(rolled: DataFrame, windows: DataFrame, by: Keys, measures: Mapping[str, Measure], top: int = TOP) -> DataFrame:
    """The summaries of every window: `windows` has the keys, `first` and `last`, and columns that name the window.

    Each run of `runs_of` that has days is met by the kept run with the same days: the shortest run around these lies in the
    window, and the next one above the kept run does not. Entities without a row in a window have none here.
    """
    keys = as_keys(by)
    names = [c for c in windows.columns if c not in (*keys, "first", "last")]
    windows = _widened(rolled, windows, keys, top)
    summaries = sorted((c for c in rolled.columns if c not in (*keys, RUN, PART)), key=lambda c: c.endswith("_on"))  # NULLs compress best side by side
    read = rolled.filter(F.array_contains(_end_parts(windows, top), F.col(PART)) | (F.col(PART) >= top * YEARS))
    read = read.select(*keys, *summaries)
    day = F.unix_date("first_day")
    differs = day.bitwiseXOR(F.unix_date("last_day"))
    own = F.when(differs == 0, 0).otherwise(_low_bits(F.length(F.bin(differs))))

    def inside(bits: Column) -> Column:
        """Whether the run around the days, whose number lacks these bits, lies in the window."""
        begins, ends = day.bitwiseAND(F.bitwise_not(bits)), day.bitwiseOR(bits)
        return (begins >= F.col("_first")) & (ends <= F.col("_last"))

    met = windows.join(read, keys) if keys else windows.crossJoin(read)
    met = met.filter(inside(own) & ((F.col(LEVEL) == top) | ~inside(_low_bits(F.col(LEVEL) + 1))))
    return met.groupBy(*keys, *names).agg(*_merged(measures, whole=True))


def _widened(rolled: DataFrame, windows: DataFrame, keys: Sequence[str], top: int) -> DataFrame:
    """The windows of entities with rows, as days `_first` and `_last`: an end with no day of the entity beyond it is that of
    a run of the highest level, so that the longest runs lie inside."""
    whole = rolled.filter(F.col(PART) >= top * YEARS).groupBy(*keys)
    whole = whole.agg(F.unix_date(F.min("first_day")).alias("_from"), F.unix_date(F.max("last_day")).alias("_to"))
    first, last, rest = F.unix_date("first"), F.unix_date("last"), F.lit((1 << top) - 1)
    begins = F.when(first <= F.col("_from"), F.least(first, F.col("_from").bitwiseAND(F.bitwise_not(rest)))).otherwise(first)
    ends = F.when(last >= F.col("_to"), F.greatest(last, F.col("_to").bitwiseOR(rest))).otherwise(last)
    placed = windows.join(whole, keys) if keys else windows.crossJoin(whole)
    return placed.select(*(c for c in windows.columns if c not in ("first", "last")), begins.alias("_first"), ends.alias("_last"))


def _low_bits(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), n) - 1


def _end_parts(windows: DataFrame, top: int) -> Column:
    """The partitions, at most a few per level and year, of the runs below the highest level whose next run has an end of a
    window in it."""
    cut = F.array("_first", F.col("_last") + 1)  # a run of the highest level that begins at a cut lies on one side of it
    ends = windows.select(F.explode(F.filter(cut, lambda d: d.bitwiseAND(F.lit((1 << top) - 1)) != 0)).alias("_end")).distinct()
    near = ends.select("_end", F.explode(F.array(*[F.lit(k) for k in range(top)]).cast("array<int>")).alias(LEVEL))
    half = F.shiftleft(_right(F.col("_end"), F.col(LEVEL) + 1), 1)
    parts = near.select(F.explode(F.array(_part(F.col(LEVEL), half), _part(F.col(LEVEL), half + 1))).alias(PART))
    return parts.agg(F.collect_set(PART).alias("_parts")).scalar()


def trailing_windows(
    rolled: DataFrame, by: Keys, choices: Sequence[int | None], top: int = TOP, returns: bool = True, shared: bool = False
) -> DataFrame:
    """keys, days (NULL: everything), first, last: the trailing windows of every entity.

    They end at the entity's last day, or with `shared` at the last day of all. With `returns` a window reaches back
    a day less. Only rows of the highest level are read.
    """
    keys = as_keys(by)
    whole = rolled.filter(F.col(PART) >= top * YEARS).groupBy(*keys).agg(F.min("first_day").alias("_from"), F.max("last_day").alias("_to"))
    if shared:
        newest = rolled.filter(F.col(PART) >= top * YEARS).agg(F.max("last_day").alias("_newest")).scalar()
        whole = whole.withColumn("_to", newest)
    reach = [(d, span_days(d) if returns else d) for d in choices]
    cells = [
        F.struct(F.lit(d).cast("int").alias("days"), (F.col("_from") if r is None else F.date_sub("_to", r)).alias("first"))
        for d, r in reach
    ]
    return whole.select(*keys, F.col("_to").alias("last"), F.inline(F.array(*cells))).select(*keys, "days", "first", "last")
