"""Event-time aggregates that are released once a period is closed.

Windows of a day are cut at midnight UTC. Event times are therefore taken as wall-clock times and placed on the
UTC clock, so that days and months are those a reader of the data sees, whatever the session's time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arealis.functions.columns import month_number


def wall_clock(ts: str) -> Column:
    """The time as shown, as an instant on the UTC clock."""
    second = F.expr(f"extract(SECOND FROM `{ts}`)")
    return F.make_timestamp(F.year(ts), F.month(ts), F.day(ts), F.hour(ts), F.minute(ts), second, F.lit("UTC"))


def wall_day(instant: Column) -> Column:
    """Date of an instant on the UTC clock."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


def with_event_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time as ``TIMESTAMP`` with a watermark; rows later than ``delay`` behind the newest are dropped."""
    return stream.withColumn(ts, wall_clock(ts)).withWatermark(ts, delay)


def daily_zonal(
    stream: DataFrame, zone: list[str], value: str, ts: str = "ts", delay: str = "1 day"
) -> DataFrame:
    """Sum, mean and count per zone and day; on a stream a day appears when the watermark has passed its end."""
    timed = with_event_time(stream, ts, delay)
    grouped = timed.groupBy(F.window(ts, "1 day").alias("w"), *zone).agg(
        F.sum(value).alias("sum"), F.avg(value).alias("mean"), F.count(value).alias("n")
    )
    return grouped.select(wall_day(F.col("w.start")).alias("day"), *zone, "sum", "mean", "n")


def monthly_from_daily(daily: DataFrame, zone: list[str]) -> DataFrame:
    """Closed days -> whole months; sums and counts add up, so the mean is exact.

    Days close in order, so a month is whole once its last day, or any later one, is there; open months are left out.
    """
    newest = daily.agg(F.max("day").alias("newest")).scalar()
    whole = daily.where(F.last_day("day") <= newest)
    monthly = whole.groupBy(*zone, F.year("day").alias("year"), F.month("day").alias("month"))
    return monthly.agg(F.sum("sum").alias("sum"), F.sum("n").alias("n")).withColumn(
        "mean", F.try_divide(F.col("sum"), F.col("n"))
    )


def closed_months(
    stream: DataFrame, zone: list[str], value: str, grace_months: int, ts: str = "ts"
) -> DataFrame:
    """Month totals, released once a row of a later month has arrived (``grace_months`` further on).

    The first of the month is the event time, so all rows of a month expire together; rows arriving for a
    released month are dropped by the engine. Where they must not be lost, use ``add_to_ledger``.
    """
    zero = F.lit(0)
    first = F.make_timestamp(F.year(ts), F.month(ts), F.lit(1), zero, zero, zero, F.lit("UTC"))
    timed = stream.withColumn("_month", first).withWatermark("_month", f"{31 * grace_months} days")
    grouped = timed.groupBy(F.window("_month", "1 day").alias("w"), *zone).agg(
        F.sum(value).alias("sum"), F.count(value).alias("n")
    )
    start = wall_day(F.col("w.start"))
    return grouped.select(F.year(start).alias("year"), F.month(start).alias("month"), *zone, "sum", "n")


LEDGER_TIME = ["year", "month"]


def add_to_ledger(folder: str, zone: list[str], value: str, grace_months: int, ts: str = "ts") -> Callable[[DataFrame, int], None]:
    """Batch writer that keeps month totals of each batch, marked late where their month was released before.

    A month is released when a row of a month more than ``grace_months`` after it has arrived in an earlier batch. A repeated
    batch replaces its own totals. ``released_months`` and ``late_rows`` read the ledger; together they hold every row.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        before = _ledger(batch.sparkSession, folder, batch_id)
        newest = before.agg(F.max(month_number())).first()[0] if before is not None else None
        totals = batch.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month"), *zone).agg(
            F.sum(value).alias("sum"), F.count(value).alias("n"), F.count(F.lit(1)).alias("n_rows")
        )
        late = F.lit(False) if newest is None else month_number() < newest - grace_months
        totals.withColumn("late", late).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return write


def _ledger(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame | None:
    try:
        found = spark.read.parquet(folder)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return found if before is None else found.where(F.col("batch") < before)


def released_months(spark: SparkSession, folder: str, zone: list[str], grace_months: int) -> DataFrame:
    """Totals of the released months from the rows that arrived in time."""
    found = _ledger(spark, folder)
    newest = found.agg(F.max(month_number()).alias("newest")).scalar()
    in_time = found.where(~F.col("late") & (month_number() < newest - grace_months))
    return in_time.groupBy(*LEDGER_TIME, *zone).agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"))


def late_rows(spark: SparkSession, folder: str, zone: list[str]) -> DataFrame:
    """Number and sum of the rows that came for a month after its release."""
    late = _ledger(spark, folder).where("late")
    return late.groupBy(*LEDGER_TIME, *zone).agg(F.sum("sum").alias("sum"), F.sum("n_rows").alias("n_rows"))


def append_available(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Write what is closed so far to a parquet table and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
