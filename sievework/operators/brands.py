"""First matching pattern of a large table: an index of the patterns' literal ends, looked up by equality."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names

#: Names with one literal that a task of the join gets, about.
TASK_NAMES = 1 << 18


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        patterns = batch.column("pattern").to_pylist()
        ends = [names.literal_ends(p) for p in patterns]
        side = ["head" if len(h) >= len(t) else "tail" for h, t in ends]
        text = [h if s == "head" else t for s, (h, t) in zip(side, ends)]
        columns = [batch.column("ordinal"), batch.column("brand"), pa.array([names.glob_regex(p) for p in patterns], pa.string()), pa.array(side), pa.array(text, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["ordinal", "brand", "regex", "side", "literal"])


def index(patterns: DataFrame) -> DataFrame:
    """(ordinal, brand, regex, side, literal, n): of each pattern the longer one of its literal head and tail, and its length in characters."""
    rows = patterns.where("pattern is not null").select(F.col("ordinal").cast("long").alias("ordinal"), F.col("brand").cast("string").alias("brand"), "pattern")
    return rows.mapInArrow(_indexed, "ordinal long, brand string, regex string, side string, literal string").withColumn("n", F.char_length("literal"))


def dealt(keys: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with _part: names (_given) of a literal that more than ``TASK_NAMES`` have are dealt out, its patterns go to every part."""
    many = keys.groupBy("side", "literal").agg(F.ceil(F.count(F.lit(1)) / TASK_NAMES).cast("int").alias("_parts")).where("_parts > 1")
    many = F.broadcast(many)  # a row for each TASK_NAMES keys, at most
    parts = F.coalesce("_parts", F.lit(1))
    own = keys.join(many, ["side", "literal"], "left").withColumn("_part", F.pmod(F.xxhash64("_given"), parts).cast("int"))
    every = found.join(many, ["side", "literal"], "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return own.drop("_parts"), every.drop("_parts")


def with_first_match(rows: DataFrame, name: str, patterns: DataFrame) -> DataFrame:
    """The rows with brand, that of the least ordinal among the patterns (ordinal, brand, pattern) whose glob matches the name; null without any.

    Each distinct name is cut at the lengths that literals have and looked up by equality; only what is found is matched as a whole.
    Patterns with neither head nor tail ('*', '*x*') can't be looked up: each of them is tried on every distinct name. Names with a
    literal that very many have ('.jpg') are counted and dealt to as many parts as they need, and the literal's patterns go to each
    of these. Ties of ordinal go to the smaller brand. Null names have no brand."""
    found = index(patterns)
    lengths = sorted((r["side"], r["n"]) for r in found.select("side", "n").distinct().collect())  # two for each length of a pattern, at most
    distinct = rows.select(F.col(name).alias("_given")).where("_given is not null").distinct()
    size = F.char_length("_given")
    cuts = [F.when(size >= n, F.struct(F.lit(s).alias("side"), (F.substring("_given", 1, n) if s == "head" else F.right("_given", F.lit(n))).alias("literal"))) for s, n in lengths]
    if not cuts:
        return rows.withColumn("brand", F.lit(None).cast("string"))
    keys = distinct.select("_given", F.explode(F.array_compact(F.array(*cuts))).alias("k")).select("_given", "k.side", "k.literal")
    keys, found = dealt(keys, found)
    met = keys.join(found, ["side", "literal", "_part"]).where(F.rlike(F.col("_given"), F.col("regex")))
    best = met.groupBy("_given").agg(F.min(F.struct("ordinal", "brand")).alias("_best"))
    return rows.join(best, F.col(name) == F.col("_given"), "left").withColumn("brand", F.col("_best.brand")).drop("_given", "_best")
