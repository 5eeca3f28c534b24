"""Incremental versions of the upsert, the trailing counts and the return history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesframe.functions.columns import utc_date
from seriesframe.functions.ordered import CHUNK, chunk_of
from seriesframe.operators.returns import returns
from seriesframe.sources.tables import PERIOD, nullable, period_of, read_table
from seriesframe.sources.upsert import upsert
from seriesframe.sources.workspace import Folder, new_path


def stream_landing(
    spark: SparkSession, folder: str, schema: T.StructType | str, one_per_file: bool = True, files_per_batch: int = 1000
) -> DataFrame:
    """Landed documents as a stream; the row rules for batch documents apply to it unchanged."""
    return (
        spark.readStream.schema(schema)
        .option("multiLine", one_per_file)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
    )


def stream_upsert(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    keys: Sequence[str],
    dt: str,
    checkpoint: str,
    order_col: str | None = None,
    grain: str = "month",
) -> DataFrame:
    """Merge everything that has landed since the last call and return the table.

    A batch delivered again after a failure merges to the same rows.
    """

    def merge(batch: DataFrame, _: int) -> None:
        upsert(batch.sparkSession, target, batch, keys, dt, order_col, grain)

    query = (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_table(spark, target)


def sliding_counts(events: DataFrame, ts: str, cat: str, days: int = 7) -> DataFrame:
    """Events per category and window of `days` days, a window beginning on every day."""
    daily = events.groupBy(cat, utc_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return window_sums(daily, cat, days)


def window_sums(daily: DataFrame, cat: str, days: int) -> DataFrame:
    """Sums of the days' counts n over every window that holds one of the days."""
    starts = F.explode(F.sequence(F.date_sub("day", days - 1), F.col("day")))
    return (
        daily.withColumn("window_start", starts)
        .groupBy(cat, "window_start")
        .agg(F.sum("n").alias("count"))
        .select(cat, "window_start", F.date_add("window_start", days).alias("window_end"), "count")
    )


def sliding_counts_table(
    spark: SparkSession, events: DataFrame, ts: str, cat: str, key: str, target: str, checkpoint: str, days: int = 7
) -> DataFrame:
    """Keep a table of sliding counts up to date with what has landed, however late it is.

    Landed events are merged by `key` into `<target>_events`, in partitions of a day. Only the days
    a batch touches are counted again, into `<target>_days`, and only the windows over these days are
    summed again. There is no state and no watermark, and a batch delivered again gives the same
    tables. An event keeps its time and category; one without key, time or category fails the job.
    """

    def merge(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        staged = Folder(session, new_path(session, "events"))
        try:
            batch.select(key, cat, utc_date(ts).alias("day")).write.parquet(staged.path)
            landed = session.read.parquet(staged.path)
            if landed.isEmpty():
                return
            if not landed.filter(F.greatest(*[F.col(c).isNull() for c in (key, cat, "day")])).isEmpty():
                raise ValueError(f"events without {key}, {ts} or {cat}")
            # at most one row per calendar day
            touched = F.broadcast(landed.select(F.col("day").alias("_day")).distinct())
            stored = upsert(session, f"{target}_events", landed, [key, "day"], "day", grain="day")
            counted = stored.join(touched, F.col(PERIOD) == F.col("_day"), "left_semi").groupBy(cat, "day")
            daily = upsert(
                session, f"{target}_days", counted.agg(F.count(F.lit(1)).alias("n")), [cat, "day"], "day", grain="year"
            )
            near = touched.select(F.explode(F.sequence(F.date_sub("_day", days - 1), F.col("_day"))).alias("_start"))
            sums = window_sums(daily.select(cat, "day", "n"), cat, days)
            sums = sums.join(F.broadcast(near.distinct()), F.col("window_start") == F.col("_start"), "left_semi")
            upsert(session, target, sums, [cat, "window_start"], "window_start")
        finally:
            staged.delete()

    query = (
        events.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_table(spark, target)


def recover_late(
    spark: SparkSession,
    bars: str,
    gold: str,
    batch: DataFrame,
    ent: str = "symbol",
    dt: str = "date",
    val: str = "close",
    order_col: str | None = "fetched_at",
    grain: str = "month",
    prev_dt: str | None = None,
) -> DataFrame:
    """Merge late bars and bring the returns of the touched entities up to date.

    No return before an entity's earliest re-landed date can have changed, so returns are
    recomputed from there on; of the older history only each entity's last bar is needed.
    Columns that the bars and the gold table share are brought along, `prev_dt` names the
    gold table's column for the previous date, and its other columns stay as they are.
    Limits are joined on (entity, chunk), so an entity with many rows is spread.
    """
    at = Folder(spark, new_path(spark, "late"))
    try:
        batch.write.parquet(f"{at.path}/batch")
        late = read_table(spark, f"{at.path}/batch", nullable(batch.schema))
        history = upsert(spark, bars, late, [ent, dt], dt, order_col, grain)
        shared = [c for c in history.columns if c in read_table(spark, gold).columns and c not in (ent, dt, val, PERIOD)]
        history = history.select(ent, dt, val, *shared, PERIOD).withColumn(CHUNK, chunk_of(history, dt))
        since = late.filter(F.col(ent).isNotNull() & F.col(dt).isNotNull()).groupBy(ent).agg(F.min(dt).alias("_since"))
        ends = history.agg(F.min(dt).alias("lo"), F.max(dt).alias("hi"))

        def limits(first: Column, last: Column) -> DataFrame:
            chunks = F.sequence(chunk_of(history, dt, first), chunk_of(history, dt, last))
            return since.select(F.col(ent).alias("_ent"), "_since", F.explode(chunks).alias("_c"))

        match = (F.col(ent) == F.col("_ent")) & (F.col(CHUNK) == F.col("_c"))
        first = since.agg(F.min("_since").alias("_first")).scalar()
        recent = history.filter((F.col(PERIOD) >= period_of(first, grain)) & (F.col(dt) >= first))
        changed = recent.join(limits(F.col("_since"), ends.select("hi").scalar()), match).filter(F.col(dt) >= F.col("_since"))
        older = history.join(limits(ends.select("lo").scalar(), F.col("_since")), match).filter(F.col(dt) < F.col("_since"))
        base = older.groupBy(ent).agg(F.max_by(val, dt).alias(val), F.max(dt).alias(dt), F.max("_since").alias("_since"))
        columns = [ent, dt, val, *shared, "_since"]
        changed.select(*columns).unionByName(base, allowMissingColumns=True).write.parquet(f"{at.path}/rows")
        rows = spark.read.parquet(f"{at.path}/rows")
        fresh = returns(rows, ent, dt, val, prev_dt=prev_dt).filter(F.col(dt) >= F.col("_since")).drop("_since")
        return upsert(spark, gold, fresh, [ent, dt], dt, None, grain, columns=[c for c in fresh.columns if c not in (ent, dt)])
    finally:
        at.delete()
