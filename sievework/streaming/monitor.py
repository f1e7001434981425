"""The hourly monitor: predictions of a batch against each brand's newest baseline, drift signals written once, alarms from what was written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import Drift
from ..operators import drift
from ..sources import keyed, sinks

EVERY = "1 hour"
SIGNALS = T.StructType(
    [T.StructField("endpoint", T.StringType()), T.StructField("ts", T.TimestampType()), T.StructField("level", T.IntegerType())]
    + [T.StructField("brand_id", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("correction_rate", T.DoubleType()), T.StructField("rate", T.DoubleType())]
    + [T.StructField("reasons", T.ArrayType(T.StringType())), T.StructField("predictions", T.LongType())]
)


def assess(predictions: DataFrame, rates: DataFrame, settings: Drift = Drift()) -> DataFrame:
    """(endpoint, ts, level, brand_id, confidence, correction_rate, rate, reasons, predictions), a row an endpoint: its level by the monitor's
    scale over (endpoint, brand_id, ts, confidence, corrected).

    ``rates``: (brand_id, rate), the correction rate that each brand was released with; a brand without one is an error. ``ts`` is that of the
    newest prediction. Null confidences and corrections aren't counted; an endpoint with none of either is at the highest level."""
    by = predictions.groupBy("endpoint", "brand_id").agg(
        F.max("ts").cast("timestamp").alias("ts"), F.avg("confidence").alias("confidence"), F.avg(F.col("corrected").cast("double")).alias("correction_rate"), F.count(F.lit(1)).alias("predictions")
    )
    joined = drift.with_rates(by, rates)
    level, reasons = drift.monitor_level(F.col("confidence"), F.col("correction_rate"), F.col("rate"), settings)
    return joined.withColumn("level", level.cast("int")).withColumn("reasons", reasons).select(SIGNALS.names)


def write_signals(assessed: DataFrame, path: str, commit: str) -> None:
    """Add a batch's signals. A batch that is replayed replaces its own."""
    keyed.append_once(sinks.drift_signals(assessed, *SIGNALS.names[3:]), path, commit)


def signals(spark: SparkSession, path: str) -> DataFrame:
    return keyed.read(spark, path, SIGNALS)


def newest_rates(baselines: DataFrame, rate: str = "rate") -> DataFrame:
    """(brand_id, rate) of each brand's newest baseline, from (brand, model, created_at, ``rate``)."""
    newest = keyed.latest(baselines.select("brand", "model", "created_at", F.col(rate).alias("rate")), ("brand",), "created_at", "model")
    return newest.select(F.col("brand").alias("brand_id"), "rate")


def monitor(stream: DataFrame, rates: Callable[[], DataFrame], path: str, checkpoint: str, name: str = "monitor", settings: Drift = Drift(), every: str | None = EVERY, then: Callable[[int], None] | None = None) -> StreamingQuery:
    """Assess each micro-batch and add its signals to ``path`` under the batch's number, so that a batch that is run again after a failure leaves
    the same rows once. ``rates`` is asked anew for each batch: a new baseline counts from the next batch on. ``every``: the trigger's
    interval; None takes what is there and ends. ``then`` is called with the number when a batch's signals are there."""

    def batch(df: DataFrame, number: int) -> None:
        write_signals(assess(df, rates(), settings), path, f"{name}-{number}")
        if then:
            then(number)

    writer = stream.writeStream.queryName(name).foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def alarms(spark: SparkSession, path: str, seconds: int = 300) -> DataFrame:
    """The level alarms of every window that has a signal in the written table."""
    return drift.alarms(signals(spark, path), seconds)
