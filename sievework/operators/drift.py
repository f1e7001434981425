"""Drift metrics and the two level scales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Drift

UNMEASURED = 1e308  # finite, so that strict JSON can hold it


def mean_confidence(df: DataFrame, probs: str = "pred_probs", by: list[str] | None = None) -> DataFrame:
    """confidence and confidence_measured: mean of each row's greatest probability; empty or NaN is unmeasured, 0."""
    mean = F.avg(F.array_max(probs))
    ok = mean.isNotNull() & ~F.isnan(mean)
    return (df.groupBy(*by) if by else df.groupBy()).agg(F.when(ok, mean).otherwise(0.0).alias("confidence"), ok.alias("confidence_measured"))


def multiplier(observed: Column, baseline: Column) -> Column:
    """observed / baseline; unmeasured for null, negative or non-finite rates and for a baseline of 0."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    ok = finite(observed) & finite(baseline) & (observed >= 0) & (baseline > 0)
    return F.when(F.coalesce(ok, F.lit(False)), observed / baseline).otherwise(F.lit(UNMEASURED))


def step_level(confidence: Column, mult: Column, c: Drift = Drift()) -> Column:
    """0 healthy, 1 watch, 2 block; a limit itself isn't beyond it. Null or NaN block."""
    bad = confidence.isNull() | mult.isNull() | F.isnan(confidence) | F.isnan(mult)
    return F.when(bad | (confidence < c.level1_floor) | (mult > c.multiplier), 2).when((confidence < c.level2_threshold) | (mult > 1.0), 1).otherwise(0)


def step_status(df: DataFrame, c: Drift = Drift()) -> DataFrame:
    """Add level, status and reasons to rows of confidence, confidence_measured, observed, baseline."""
    rows = df.withColumn("correction_rate_multiplier", multiplier(F.col("observed"), F.col("baseline")))
    rows = rows.withColumn("correction_rate_measured", F.col("correction_rate_multiplier") < UNMEASURED)
    rows = rows.withColumn("level", step_level(F.col("confidence"), F.col("correction_rate_multiplier"), c))
    reasons = F.array_compact(F.array(F.when(~F.col("confidence_measured"), F.lit("confidence_unmeasured")), F.when(~F.col("correction_rate_measured"), F.lit("correction_rate_unmeasured"))))
    ok = F.col("confidence_measured") & F.col("correction_rate_measured") & (F.col("level") < 2)
    return rows.withColumn("status", F.when(ok, "ok").otherwise("failed")).withColumn("reasons", reasons)


def monitor_level(confidence: Column, rate: Column, baseline: Column, c: Drift = Drift()) -> tuple[Column, Column]:
    """(level 0 to 3, reasons): the highest that applies; at the limit the correction rate has spiked. A negative baseline is an error."""
    checked = F.when(baseline < 0, F.raise_error(F.lit("baseline_correction_rate must be non-negative")).cast("double")).otherwise(baseline)
    spike = F.coalesce(F.when(checked == 0, rate > 0).otherwise(rate >= checked * c.multiplier), F.lit(True))
    low = F.coalesce(confidence < c.level2_threshold, F.lit(True))
    floor = F.coalesce(confidence < c.level1_floor, F.lit(True))
    level = F.when(spike, 3).when(floor, 2).when(low, 1).otherwise(0)
    # Reason strings; their names and the settings' are swapped, and consumers know them so.
    reasons = F.array_compact(F.array(F.when(low, F.lit("confidence_below_level1_threshold")), F.when(floor, F.lit("confidence_below_level2_floor")), F.when(spike, F.lit("correction_rate_spike"))))
    return level, reasons


def correction_rates(events: DataFrame, by: Column, corrected: Column, since: Column) -> DataFrame:
    """(tenant, observed, baseline): share of corrected rows from ``since`` on, and before."""
    rate = lambda w: F.avg(F.when(w, corrected.cast("double")))
    return events.groupBy(by.alias("tenant")).agg(rate(since).alias("observed"), rate(~since).alias("baseline"))


def with_rates(brands: DataFrame, rates: DataFrame) -> DataFrame:
    """The rates of each brand; a brand without one is an error."""
    joined = brands.join(rates, "brand_id", "left")
    rate = F.when(F.col("rate").isNull(), F.raise_error(F.concat(F.lit("no correction rate for "), F.col("brand_id"))).cast("double")).otherwise(F.col("rate"))
    return joined.withColumn("rate", rate)


def alarms(signals: DataFrame, seconds: int = 300) -> DataFrame:
    """(endpoint, window_start, level, level1, level2, level3): greatest level in each tumbling window; no row, no alarm."""
    w = F.window(F.col("ts"), f"{seconds} seconds")
    top = signals.groupBy(w.alias("w"), "endpoint").agg(F.max("level").alias("level"))
    return top.select("endpoint", F.col("w.start").alias("window_start"), "level", *((F.col("level") >= n).alias(f"level{n}") for n in (1, 2, 3)))
