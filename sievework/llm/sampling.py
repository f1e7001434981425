"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 30


def bounded_rows(df: DataFrame, by: str, key: str, most: int, groups: int | None = 200) -> DataFrame:
    """About ``most`` rows of each value of ``by`` (all, if fewer), of its ``groups`` most common values, or of every value where ``groups`` is None; chosen by a hash of
    ``key``, so that the same rows are taken in every run and layout. No value is gathered in one task: only counts are shuffled."""
    counted = df.where(F.col(by).isNotNull()).groupBy(by).count()
    slot = F.pmod(F.xxhash64(F.col(key), F.lit(20)), F.lit(SLOTS))
    if groups is None:
        share = counted.select(by, F.col("count").alias("_count"))
        within = (F.col("_count") <= most) | (slot < F.floor(F.lit(SLOTS * most) / F.col("_count")))
        return df.join(share, by).where(within).drop("_count")  # one row a value, however many there are
    counts = counted.orderBy(F.desc("count"), by).limit(groups).collect()
    taken: Column = F.lit(False)
    for r in counts:
        here = F.col(by) == F.lit(r[by])
        taken = taken | (here if r["count"] <= most else here & (slot < int(SLOTS * most / r["count"])))
    return df.where(taken)
