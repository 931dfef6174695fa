"""Open months as keyed state of a stream: totals per zone and month, closed by a timer, late rows in a second output.

A month closes once a row of a month more than ``grace_months`` after it has arrived in an earlier micro-batch. Its totals are
then written, whole and once, and its state goes. Rows that come for a closed month are written as late rows, with their number
and sum; no row is dropped. So closed months and late rows together hold every row of the closed months.

* Rows are summed per key and Arrow batch where they are read; only such partial sums are shuffled, so a frequent zone or month
  does not load one task.
* The clock of the stream is the engine's watermark, the newest row so far. The column that carries it ends before the stateful
  operator, which therefore sees late rows too instead of losing them to the engine.
* State holds the open months only, one entry per zone and month.

Rows without a time belong to no month; they come out as late rows without year and month.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import DecimalType, StructType

from arealis.streaming.windows import LEDGER_TIME, wall_clock

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Months per row group are few; the clock is moved by this many days, so that it is above zero for dates since the year 1000.
CLOCK_DAYS = 365_250
EPOCH = dt.date(1970, 1, 1)
CLOSED, LATE = "closed", "late"


def closing(year: int, month: int, grace_months: int) -> int:
    """Clock value in milliseconds that is passed when a row of a month that closes this one has arrived."""
    at = year * 12 + month - 1 + grace_months + 1
    days = (dt.date(at // 12, at % 12 + 1, 1) - EPOCH).days + CLOCK_DAYS
    return days * 86_400_000 - 1


def plus(a, b):
    """Sum in which a missing part adds nothing."""
    return b if a is None else a if b is None else a + b


class OpenMonths(StatefulProcessor):
    """Adds partial sums to the state of (year, month, zone ...) until its timer closes the month."""

    def __init__(self, names: list[str], grace_months: int, sum_type: str) -> None:
        self.names, self.grace_months, self.sum_type = names, grace_months, sum_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", f"sum {self.sum_type}, n long, n_rows long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        total, n, n_rows = None, 0, 0
        for r in rows:
            total, n, n_rows = plus(total, r["sum"]), n + r["n"], n_rows + r["n_rows"]
        year, month = key[:2]
        closes = None if year is None else closing(year, month, self.grace_months)
        if closes is None or closes < timerValues.getCurrentWatermarkInMs():
            yield self.row(LATE, key, total, n, n_rows)
            return
        if self.total.exists():
            held = self.total.get()
            total, n, n_rows = plus(held[0], total), held[1] + n, held[2] + n_rows
        else:
            self.handle.registerTimer(closes)
        self.total.update((total, n, n_rows))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.total.exists():
            yield self.row(CLOSED, key, *self.total.get())
            self.total.clear()

    def close(self) -> None:
        pass

    def row(self, kind: str, key: tuple, total, n: int, n_rows: int) -> Row:
        return Row(**dict(zip(self.names, (kind, *key, total, n, n_rows), strict=True)))


def partial_sums(stream: DataFrame, zone: list[str], value: str, ts: str) -> DataFrame:
    """year, month, zone, sum, n, n_rows and the newest time, one row per key and Arrow batch."""
    timed = stream.select(wall_clock(ts).alias("_clock"), *zone, F.col(value).alias("_value"))
    keyed = timed.select(F.year("_clock").alias("year"), F.month("_clock").alias("month"), *zone, "_value", F.lit(1).alias("_one"), "_clock")
    by = [*LEDGER_TIME, *zone]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by(by).aggregate([("_value", "sum"), ("_value", "count"), ("_one", "count"), ("_clock", "max")])
            ordered = sums.select([*by, "_value_sum", "_value_count", "_one_count", "_clock_max"])
            yield from ordered.rename_columns([*by, "sum", "n", "n_rows", "_clock"]).to_batches()

    kinds = {f.name: f.dataType.simpleString() for f in keyed.schema}
    schema = [f"`{k}` {kinds[k]}" for k in by] + [f"sum {sum_type(stream, value)}", "n long", "n_rows long", "_clock timestamp"]
    return keyed.withColumn("_value", F.col("_value").cast(sum_type(stream, value))).mapInArrow(run, ", ".join(schema))


def sum_type(stream: DataFrame, value: str) -> str:
    """Decimals add up exactly, in any order, whole numbers as such; the rest as doubles."""
    kind = stream.schema[value].dataType
    if isinstance(kind, DecimalType):
        return f"decimal(38,{kind.scale})"
    return "long" if kind.typeName() in ("byte", "short", "integer", "long") else "double"


def open_months(stream: DataFrame, zone: list[str], value: str, grace_months: int, ts: str = "ts") -> DataFrame:
    """Stream of closed months and late rows: kind, year, month, zone, sum, n (values), n_rows."""
    partial = partial_sums(stream, zone, value, ts)
    moved = partial.withColumn("_clock", F.col("_clock") + F.expr(f"INTERVAL '{CLOCK_DAYS}' DAY"))
    keys = [*LEDGER_TIME, *zone]
    sums = moved.withWatermark("_clock", "0 seconds").select(*keys, "sum", "n", "n_rows")
    names = ["kind", *keys, "sum", "n", "n_rows"]
    kinds = {"kind": "string"} | {f.name: f.dataType.simpleString() for f in sums.schema}
    processor = OpenMonths(names, grace_months, kinds["sum"])
    return sums.groupBy(*keys).transformWithState(
        processor, ", ".join(f"`{k}` {kinds[k]}" for k in names), outputMode="append", timeMode="eventTime"
    )


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started in here keep their state in RocksDB, which timers and value states need."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def run_months(months: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived and stop. A micro-batch replaces its own output, so a repeated one adds nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("kind").parquet(f"{folder}/batch={batch_id}")

    with keyed_state(months.sparkSession):
        query = months.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return query


def _output(spark: SparkSession, folder: str, schema: StructType | str, kind: str) -> DataFrame:
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    try:
        found = spark.read.schema(schema).option("basePath", folder).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema).drop("kind")
    return found.where(F.col("kind") == kind).drop("kind", "batch")


def closed(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """The closed months so far, one row per zone and month. ``schema`` is that of ``open_months``."""
    return _output(spark, folder, schema, CLOSED)


def late(spark: SparkSession, folder: str, schema: StructType | str, zone: list[str]) -> DataFrame:
    """Number and sum of the rows that came for a month after it was closed."""
    found = _output(spark, folder, schema, LATE)
    return found.groupBy(*LEDGER_TIME, *zone).agg(F.sum("sum").alias("sum"), F.sum("n_rows").alias("n_rows"))
