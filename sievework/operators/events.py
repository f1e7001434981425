"""Upload events: normalise, match, coalesce, suppress."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names
from . import brands

OBJECT = "struct<bucket:struct<name:string>,object:struct<key:string>>"
EVENT = f"struct<Records:array<struct<s3:{OBJECT}>>,detail:{OBJECT}>"
TERMINAL_FREE = ("Executing", "Stopping")
PUBLISH_BATCH = 10


def uploads(raw: DataFrame, value: str = "value") -> DataFrame:
    """Rows with bucket and decoded key from both event shapes; entries that lack either are dropped. Other columns stay."""
    e = F.from_json(F.col(value), EVENT)
    found = raw.withColumn("_e", e).withColumn("_o", F.concat(F.coalesce(F.col("_e.Records.s3"), F.array().cast(f"array<{OBJECT}>")), F.when(F.col("_e.detail").isNotNull(), F.array("_e.detail")).otherwise(F.array().cast(f"array<{OBJECT}>"))))
    flat = found.withColumn("_o", F.explode("_o")).withColumn("bucket", F.col("_o.bucket.name")).withColumn("key", names.decoded_key(F.col("_o.object.key")))
    return flat.where("bucket <> '' AND key <> ''").drop("_e", "_o")


def with_brand(rows: DataFrame, patterns: list[tuple[str, str]] | DataFrame) -> DataFrame:
    """Rows of known brands, the first pattern in order; others are dropped. Patterns are a list of (brand, glob), or for many brands a table of
    (ordinal, brand, pattern)."""
    if isinstance(patterns, DataFrame):
        return brands.with_first_match(rows.withColumn("_name", names.basename(F.col("key"))), "_name", patterns).where("brand is not null").drop("_name")
    return rows.withColumn("brand", names.first_match(names.basename(F.col("key")), patterns)).where("brand is not null")


def coalesced(rows: DataFrame, ordinal: str, by: tuple[str, ...] = ("brand",)) -> DataFrame:
    """One request a group: bucket and key of its first row, coalesced_count only where more than one row was merged."""
    n = F.count(F.lit(1))
    return rows.groupBy(*by).agg(F.min_by(F.struct("bucket", "key"), ordinal).alias("_f"), F.when(n > 1, n).alias("coalesced_count")).select(*by, "_f.bucket", "_f.key", "coalesced_count")


def window_seconds(value: str | int | None, default: int = 300) -> int:
    """The idempotency window; anything but a positive integer gives the default."""
    try:
        return n if (n := int(value)) > 0 else default  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return default


def window_number(ts: Column, seconds: int = 300) -> Column:
    return F.floor(F.unix_timestamp(ts.cast("timestamp")) / seconds)


def display_name(pipeline: Column, brand: Column, number: Column) -> Column:
    """Equal for two starts in one window, so that the second one collides."""
    digest = F.substring(F.sha1(F.concat_ws(":", pipeline, brand, number.cast("string")).cast("binary")), 1, 12)
    return F.concat_ws("-", F.lit("brand"), names.safe_brand(brand), number.cast("string"), digest)


def publish_batches(requests: DataFrame, order: str, size: int = PUBLISH_BATCH) -> DataFrame:
    """batch: requests in order, ``size`` to a batch. There is one request a brand, so the single ordering task stays small."""
    return requests.withColumn("batch", F.floor((F.row_number().over(Window.orderBy(order)) - 1) / size))


def publish(requests: DataFrame, order: str, send: Callable[[list[dict]], int]) -> tuple[int, int]:
    """(accepted, failed) over all batches; ``send`` returns how many entries of one batch failed."""
    accepted = failed = 0
    rows: list[dict] = []
    for r in publish_batches(requests, order).orderBy("batch", order).toLocalIterator():
        if rows and r["batch"] != rows[-1]["batch"]:
            bad = send(rows)
            accepted, failed, rows = accepted + len(rows) - bad, failed + bad, []
        rows.append(r.asDict())
    if rows:
        bad = send(rows)
        accepted, failed = accepted + len(rows) - bad, failed + bad
    return accepted, failed


def suppressed(requests: DataFrame, executions: DataFrame | None) -> DataFrame:
    """Requests with skipped and reason: a brand with an execution that still runs is not started again. No listing at all (None)
    counts as running: it fails closed. With execution_id and started_at among the executions' columns, the result has the execution_id
    of the newest one that runs."""
    if executions is None:
        return requests.withColumn("skipped", F.lit(True)).withColumn("reason", F.lit("in_flight_execution"))
    running = executions.where(F.col("status").isin(*TERMINAL_FREE))
    if {"execution_id", "started_at"} <= set(executions.columns):
        running = running.groupBy("brand").agg(F.max_by("execution_id", F.struct("started_at", "execution_id")).alias("execution_id")).withColumn("_r", F.lit(True))
    else:
        running = running.select("brand").distinct().withColumn("_r", F.lit(True))
    out = requests.join(running, "brand", "left")
    return out.withColumn("skipped", F.coalesce("_r", F.lit(False))).withColumn("reason", F.when(F.col("skipped"), F.lit("in_flight_execution"))).drop("_r")


def newest_first(executions: DataFrame) -> DataFrame:
    return executions.orderBy(F.desc("started_at"), F.desc("execution_id"))


def training_events(requests: DataFrame, trigger: str = "upload") -> DataFrame:
    """(brand, detail): the event's JSON, keys in alphabetical order; coalesced_count only where it is set."""
    detail = F.to_json(F.struct("bucket", F.col("brand").alias("brand_id"), "coalesced_count", "key", F.lit(trigger).alias("trigger")))
    return requests.select("brand", detail.alias("detail"))


def unexpected_fields(body: Column, allowed: list[str]) -> Column:
    return F.array_except(F.json_object_keys(body), F.array(*map(F.lit, allowed)))


def allowed_brands(*claims: Column) -> Column:
    """Union of the brands in several claims, whatever their form."""
    out = F.array().cast("array<string>")
    for c in claims:
        out = F.array_union(out, F.coalesce(names.split_claims(c), F.array().cast("array<string>")))
    return out
