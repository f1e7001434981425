"""Tables of keyed rows that later runs add to: partitions replaced by key, and appends that a repeated run doesn't double.

Both are dynamic partition overwrites: what a write brings replaces the partitions of its own keys (or of its commit), and all others stay.
Partition values are read with the table's own types, so a brand named 007 stays a string.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT = "commit"


def _write(df: DataFrame, path: str, by: tuple[str, ...]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _with_keys(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The rows; a null key is an error when they are written, as no partition could be told by it."""
    bad = F.raise_error(F.lit(f"a key of {', '.join(keys)} is null"))
    return df.withColumns({k: F.when(F.col(k).isNull(), bad.cast(df.schema[k].dataType)).otherwise(F.col(k)) for k in keys})


def replace(df: DataFrame, path: str, keys: tuple[str, ...]) -> None:
    """Write rows in place of those with the same keys; rows of other keys stay. No rows, no change. Keys that many rows share are dealt to
    as few files as there are keys, so that a run doesn't leave one file a task and key."""
    _write(_with_keys(df, keys).repartition(*keys), path, keys)


def append_once(df: DataFrame, path: str, commit: str) -> None:
    """Add rows under a commit's name. The same commit once more replaces its own rows: a run that is repeated or retried adds nothing.

    ``commit`` must name the run, not the attempt."""
    if not commit:
        raise ValueError("a commit needs a name")
    _write(df.withColumn(COMMIT, F.lit(commit)), path, (COMMIT,))


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table with the types of ``schema`` (without ``commit``, which comes last if the table has it); empty where nothing was written yet."""
    if COMMIT not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(COMMIT, T.StringType())])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def latest(df: DataFrame, keys: tuple[str, ...], *order: str) -> DataFrame:
    """Of each key the row that is greatest in ``order``, with ties going to the greater commit: one aggregation, no key's rows in a window."""
    by = F.struct(*order, *([COMMIT] if COMMIT in df.columns and COMMIT not in order else []))
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_row")).select(*keys, *(F.col("_row")[c].alias(c) for c in rest))
