"""Train/validation split, stratified folds, out-of-sample probabilities."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialise


#: Rows of a class that one task may order.
TASK_ROWS = 1 << 20


def ranked(df: DataFrame, label_col: str, *order: Column) -> DataFrame:
    """Rows with _rank from 1 within their class, and _n, the class's size.

    Where no class has more than ``TASK_ROWS`` rows, each is ordered in a task. Else rows are dealt out by ranges of class and order, so that a class of any size is as many tasks as it needs; a row's rank is its place in
    its part after the sizes of the parts before. What is ordered in one task is one row for each part of a class."""
    sizes = df.groupBy(F.col(label_col).alias("_l")).agg(F.count(F.lit(1)).alias("_n"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= TASK_ROWS:
        within = Window.partitionBy(label_col)
        return df.withColumn("_rank", F.row_number().over(within.orderBy(*order))).withColumn("_n", F.count(F.lit(1)).over(within))
    keys = [f"_o{i}" for i in range(len(order))]
    dealt = df.withColumns(dict(zip(keys, order))).repartitionByRange(label_col, *keys).withColumn("_part", F.spark_partition_id())
    rows = materialise(dealt, "ranked")
    parts = rows.groupBy(label_col, "_part").agg(F.count(F.lit(1)).alias("_in"))
    within = Window.partitionBy(label_col)
    before = F.coalesce(F.sum("_in").over(within.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(F.col(label_col).alias("_l"), F.col("_part").alias("_p"), before.alias("_before"), F.sum("_in").over(within).alias("_n"))
    place = F.row_number().over(Window.partitionBy(label_col, "_part").orderBy(*keys))
    both = rows.withColumn("_place", place).join(parts, F.col(label_col).eqNullSafe(F.col("_l")) & (F.col("_part") == F.col("_p")))
    return both.withColumn("_rank", F.col("_before") + F.col("_place")).drop("_l", "_p", "_part", "_place", "_before", *keys)


def train_val_split(df: DataFrame, label_col: str, order_col: str, share: float = 0.2) -> DataFrame:
    """Rows with split: the first max(1, floor(n share)) of each class in order are 'val', the others 'train'. A class of one row would
    have no training row and is an error."""
    n, r = F.col("_n"), F.col("_rank")
    n_val = F.greatest(F.lit(1), F.floor(n * F.lit(share)))
    split = F.when(n == 1, F.raise_error(F.concat(F.lit("class of one row: "), F.col(label_col).cast("string"))).cast("string")).when(r <= n_val, F.lit("val")).otherwise(F.lit("train"))
    return ranked(df, label_col, F.col(order_col)).withColumn("split", split).drop("_n", "_rank")


def fold_count(df: DataFrame, label_col: str, most: int) -> int:
    """Folds that the smallest class allows; fewer than two is an error."""
    least = df.groupBy(label_col).count().agg(F.min("count")).first()[0] or 0
    if min(most, least) < 2:
        raise ValueError(f"the smallest class has {least} rows; two folds need two")
    return min(most, least)


def stratified_folds(df: DataFrame, label_col: str, id_col: str, folds: int) -> DataFrame:
    """Rows with fold: within a class, rows in the order of a hash of the id are dealt in turn, so sizes differ by one at most."""
    rows = ranked(df, label_col, F.md5(F.col(id_col).cast("string").cast("binary")), F.col(id_col))
    return rows.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")).drop("_n", "_rank")


def classes_of(df: DataFrame, label_col: str) -> list[str]:
    return [r[0] for r in df.select(F.col(label_col).cast("string")).where(F.col(label_col).isNotNull()).distinct().orderBy(label_col).collect()]


def out_of_sample(df: DataFrame, label_col: str = "label", vec_col: str = "embedding", id_col: str = "id", folds: int = 5, trees: int = 100, depth: int = 8, seed: int = 2026) -> DataFrame:
    """Rows with fold and pred_probs over the sorted classes of all rows; each row's model has not seen its fold.

    The class index is fixed before the folds, so vectors have all classes' width and a class absent from a fold's training rows has
    probability 0."""
    classes = sorted(classes_of(df, label_col))
    k = fold_count(df, label_col, folds)
    index = F.array_position(F.array(*map(F.lit, classes)), F.col(label_col).cast("string")) - 1
    rows = stratified_folds(df, label_col, id_col, k).withColumn("_y", index.cast("double")).withColumn("_x", array_to_vector(F.col(vec_col).cast("array<double>")))
    rows = materialise(rows.drop("_x"), "folds").withColumn("_x", array_to_vector(F.col(vec_col).cast("array<double>")))
    out = None
    for fold in range(k):
        model = RandomForestClassifier(featuresCol="_x", labelCol="_y", numTrees=trees, maxDepth=depth, seed=seed).fit(rows.where(F.col("fold") != fold))
        found = vector_to_array("probability")
        p = F.array(*(F.coalesce(F.get(found, F.lit(i)), F.lit(0.0)) for i in range(len(classes))))
        part = model.transform(rows.where(F.col("fold") == fold)).withColumn("pred_probs", p).drop("rawPrediction", "probability", "prediction", "_x", "_y")
        out = part if out is None else out.unionByName(part)
    return out
