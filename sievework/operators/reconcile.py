"""Checksum reconciliation of copied objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ChecksumMismatch(RuntimeError):
    pass


class CountMismatch(RuntimeError):
    pass


def checksum(sha: Column, etag: Column, key: Column) -> Column:
    """struct(algorithm, value): SHA-256 if there is one, else the ETag without quotes, else an error."""
    bare = F.regexp_replace(etag, '^"+|"+$', "")
    missing = F.raise_error(F.concat(F.lit("no checksum for "), key))
    return F.struct(
        F.when(sha.isNotNull(), "SHA256").when(etag.isNotNull(), "ETag").otherwise(missing.cast("string")).alias("algorithm"), F.coalesce(sha, bare).alias("value")
    )


def reconcile(source: DataFrame, destination: DataFrame) -> DataFrame:
    """All source rows with matched and reason, from (key, algorithm, value) on both sides; ``destination_key`` of a source row counts
    before its key. A missing destination, another algorithm or another value doesn't match; two nulls do not either."""
    s = source.withColumn("destination_key", F.coalesce(F.col("destination_key"), F.col("key")) if "destination_key" in source.columns else F.col("key"))
    d = destination.select(F.col("key").alias("destination_key"), F.col("algorithm").alias("d_algorithm"), F.col("value").alias("d_value"), F.lit(True).alias("there"))
    same = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(False))
    j = s.join(d, "destination_key", "left")
    matched = same("algorithm", "d_algorithm") & same("value", "d_value")
    reason = F.when(F.col("there").isNull(), "missing").when(~same("algorithm", "d_algorithm"), "algorithm").when(~matched, "value")
    return j.select("key", "destination_key", "algorithm", matched.alias("matched"), reason.alias("reason"))


def require_all(result: DataFrame) -> None:
    """Raise for the first row, by key, that doesn't match."""
    bad = result.where(~F.col("matched")).agg(F.min_by(F.struct("key", "reason"), "key").alias("first"), F.count(F.lit(1)).alias("n")).first()
    if bad["n"]:
        raise ChecksumMismatch(f"{bad['n']} objects differ; first {bad['first']['key']}: {bad['first']['reason']}")


def counts_agree(manifest: DataFrame, copied: DataFrame, by: str | tuple[str, ...] = "label") -> DataFrame:
    """(*by, expected, copied) where the numbers of rows differ."""
    keys = [by] if isinstance(by, str) else list(by)
    a, b = manifest.groupBy(*keys).agg(F.count(F.lit(1)).alias("expected")), copied.groupBy(*keys).agg(F.count(F.lit(1)).alias("copied"))
    return a.join(b, keys, "full").na.fill(0, ["expected", "copied"]).where("expected <> copied")
