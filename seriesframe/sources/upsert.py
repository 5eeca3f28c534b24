"""Keyed upsert into period-partitioned Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesframe.sources.tables import (
    MERGE,
    PERIOD,
    by_period,
    find_table,
    is_path,
    live_periods,
    location,
    marked,
    nullable,
    period_of,
    read_table,
    write_table,
)
from seriesframe.sources.workspace import Folder, new_path

#: Fixed value: the folder name of a NULL partition.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"

def _all_keys(keys: Sequence[str]) -> Column:
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(k).isNotNull()
    return cond


def latest_per_key_set(df: DataFrame, keys: Sequence[str], order_col: str | None) -> DataFrame:
    """One row per key, the one with the greatest `order_col`; rows with a NULL key all stay.

    An aggregate, not a window: copies of one key collapse before the shuffle. Equal
    `order_col` values are settled by the other columns, so the result is deterministic.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [order_col, *[c for c in rest if c != order_col]] if order_col else rest
    if not ranked:
        return df.filter(_all_keys(keys)).distinct().unionByName(df.filter(~_all_keys(keys)))
    keyed = (
        df.filter(_all_keys(keys))
        .groupBy(*keys)
        .agg(F.max(F.struct(*ranked)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )
    return keyed.unionByName(df.filter(~_all_keys(keys)))


def merge_rows(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order_col: str | None = None,
    keep_non_null: bool = False,
) -> DataFrame:
    """Target rows replaced by updates with equal keys, new keys added.

    NULL keys match nothing, so such updates are added every time; their rows stay out of
    the join. An update's NULL overwrites a value unless `keep_non_null` is set. Columns that
    the updates lack keep their values by key, and are NULL in new rows.
    """
    fresh = latest_per_key_set(updates, keys, order_col)
    held = [c for c in target.columns if c not in updates.columns]
    given = [c for c in fresh.columns if c not in keys and c in target.columns]
    if held or keep_non_null:
        old = target.filter(_all_keys(keys)).select(*keys, *[F.col(c).alias(f"_old_{c}") for c in target.columns if c not in keys])
        fresh = fresh.join(old, list(keys), "left").select(
            *keys,
            *[(F.coalesce(F.col(c), F.col(f"_old_{c}")) if keep_non_null else F.col(c)).alias(c) for c in given],
            *[F.col(f"_old_{c}").alias(c) for c in held],
        )
    whole = _all_keys(keys)
    kept = target.filter(whole).join(fresh.filter(whole).select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(target.filter(~whole)).unionByName(fresh.select(*target.columns))


def _check_columns(table: DataFrame, updates: DataFrame, columns: Sequence[str] | None, order_col: str | None, evolve: bool) -> None:
    """Fail before anything is written if the updates do not fit the table."""
    have, given = set(table.columns) - {PERIOD}, set(updates.columns)
    if columns is None and (have - given or given - have and not evolve):
        raise ValueError(
            f"the updates lack {sorted(have - given)} and add {sorted(given - have)}; "
            "name `columns` to update only some, or `evolve` to add some"
        )
    known = given if evolve else have & given
    if columns is not None and not set(columns) <= known:
        raise ValueError(f"not in the table and the updates alike: {sorted(set(columns) - known)}")
    if order_col and order_col not in given:
        raise ValueError(f"the updates have no column {order_col}")


def _write_periods(rows: DataFrame, target: str, dt: str, grain: str, order: Sequence[str]) -> str:
    """Write whole periods once, into a folder of their own, and return its path."""
    folder = Folder(rows.sparkSession, location(rows.sparkSession, target))
    path = f"{folder.path}/{MERGE}={max([0, *(int(n) + 1 for n in folder.children(f'{MERGE}='))])}"
    marked(by_period(rows, order), dt, grain).write.partitionBy(PERIOD).parquet(path)
    return path


def _tidy(spark: SparkSession, target: str) -> None:
    """Delete what no reader of the path sees any more: periods that were merged again, merges that were cut off."""
    live = {path for _, path in live_periods(spark, target).values()}
    for old in Folder(spark, target).children(f"{PERIOD}="):
        Folder(spark, f"{target}/{PERIOD}={old}").delete()
    for n in Folder(spark, target).children(f"{MERGE}="):
        merge = f"{target}/{MERGE}={n}"
        periods = [f"{merge}/{PERIOD}={p}" for p in Folder(spark, merge).children(f"{PERIOD}=")]
        for dead in [merge] if not live & set(periods) else [p for p in periods if p not in live]:
            Folder(spark, dead).delete()


def _move_partitions(spark: SparkSession, target: str, path: str, added: list[str]) -> None:
    """Let a catalog table's partitions lie in the folder just written, then delete the ones they replace."""
    if added:
        kinds = {f.name: f.dataType.simpleString() for f in spark.read.parquet(path).schema}
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({', '.join(f'`{c}` {kinds[c]}' for c in added)})")
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {target}").collect()}  # one row per calendar period
    replaced = []
    for period in Folder(spark, path).children(f"{PERIOD}="):
        spec = f"PARTITION ({PERIOD} = {'NULL' if period == NO_DATE else repr(period)})"
        if f"{PERIOD}={period}" in known:
            about = spark.sql(f"DESCRIBE FORMATTED {target} {spec}").filter("col_name = 'Location'").first()
            replaced.append(about.data_type)
            spark.sql(f"ALTER TABLE {target} {spec} SET LOCATION '{path}/{PERIOD}={period}'")
        else:
            spark.sql(f"ALTER TABLE {target} ADD {spec} LOCATION '{path}/{PERIOD}={period}'")
    spark.catalog.refreshTable(target)
    for old in replaced:
        Folder(spark, old).delete()


def upsert(
    spark: SparkSession,
    target: str,
    updates: DataFrame,
    keys: Sequence[str],
    dt: str,
    order_col: str | None = None,
    grain: str = "month",
    keep_non_null: bool = False,
    columns: Sequence[str] | None = None,
    evolve: bool = False,
) -> DataFrame:
    """Merge `updates` into the table `target` (a path or a catalog name), which is created on the first run.

    The updates have the table's columns, or the call fails before it writes. With `columns` only
    these are updated; the others keep their values. With `evolve` new columns are added, and rows
    that were there before have NULL in them; periods that the updates do not touch are not rewritten.

    Only the periods the updates touch are read and rewritten, once, into a new folder. A path's readers
    (`read_table`) take a period from the newest folder that Spark has finished, so they see the old table
    or the new one; a catalog table's partitions are pointed to the new folder one by one. What was replaced
    is deleted last. A driver lost at any point leaves whole periods, and running the batch again gives the new
    table. A lost executor only repeats its tasks. Two writers at once are not supported. `dt` has to be one
    of the keys: a row's period then never changes.
    """
    if dt not in keys:
        raise ValueError(f"{dt} must be one of the keys")
    order = [dt, *[k for k in keys if k != dt]]
    table = find_table(spark, target)
    if table is None:
        rows = latest_per_key_set(updates, keys, order_col)
        if not is_path(target):
            return write_table(rows, target, dt, grain, tuple(order[1:]))
        _write_periods(rows.withColumn(PERIOD, period_of(F.col(dt), grain)), target, dt, grain, order)
        found = find_table(spark, target)
        return write_table(rows, target, dt, grain, tuple(order[1:])) if found is None else found  # no rows, no periods
    _check_columns(table, updates, columns, order_col, evolve)
    if columns is not None:
        needed = dict.fromkeys([*keys, *columns, *([order_col] if order_col else [])])
        updates = latest_per_key_set(updates.select(*needed), keys, order_col).select(*dict.fromkeys([*keys, *columns]))
        order_col = order_col if order_col in columns else None
    added = [c for c in updates.columns if c not in table.columns]
    names = [*[c for c in table.columns if c != PERIOD], *added, PERIOD]
    table = table.withColumns({c: F.lit(None).cast(updates.schema[c].dataType) for c in added}).select(*names)

    staged = Folder(spark, new_path(spark, "updates"))
    placed = updates.withColumn(PERIOD, period_of(F.col(dt), grain))
    try:
        placed.write.parquet(staged.path)
        batch = spark.read.schema(nullable(placed.schema)).parquet(staged.path)
        if batch.isEmpty():
            return read_table(spark, target)
        whole_path = is_path(target) and live_periods(spark, target) is None
        affected = table if whole_path else _touched(table, batch)
        merged = merge_rows(affected, batch, keys, order_col, keep_non_null).select(*names)
        path = _write_periods(merged, target, dt, grain, order)
        if is_path(target):
            _tidy(spark, target)
        else:
            _move_partitions(spark, target, path, added)
    finally:
        staged.delete()
    return read_table(spark, target, nullable(merged.schema) if is_path(target) else None)


def _touched(table: DataFrame, batch: DataFrame) -> DataFrame:
    """The table's rows in the periods of a batch."""
    none = F.lit("0001-01-01").cast("date")
    touched = batch.select(F.coalesce(PERIOD, none).alias("_period")).distinct()
    bounds = batch.agg(F.min(PERIOD).alias("lo"), F.max(PERIOD).alias("hi"))
    in_range = (F.col(PERIOD) >= bounds.select("lo").scalar()) & (F.col(PERIOD) <= bounds.select("hi").scalar())
    # at most one row per calendar period
    return table.filter(in_range | F.col(PERIOD).isNull()).join(
        F.broadcast(touched), F.coalesce(F.col(PERIOD), none) == F.col("_period"), "left_semi"
    )
