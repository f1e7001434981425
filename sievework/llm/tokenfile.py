"""Token files: Parquet with a list column of ids in ascending order of the document id.

Ids are dictionary-encoded (a vocabulary fits one dictionary page, about two bytes an id), ids and starts of documents
delta-encoded; row groups and pages have a set size, and the writer adds page indexes, so that a reader that wants a few
documents or only the metadata reads little else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_ids, int_lists, slices_by_bytes, text_views
from .tokens import cached_tokenizer

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10


def write_tokens(df: DataFrame, path: str, out: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> None:
    """Encode every whole text and write (id, ids, n_tokens, part, start_in_part) to the folder ``out``.

    Rows are dealt out by ranges of the id and sorted, so files and rows are in ascending order; rows of one id stay together in
    any order. A null text counts as empty (its only token is the end). No rows give files without rows. Other columns are not
    read. Only Spark writes the files, so ``out`` can be in any store."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, total = cached_tokenizer(path, False), 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for a, b in slices_by_bytes(batch.column(1)):
                rows = batch.slice(a, b - a)
                ids, ends = tokenizer.encode_with_end(list(text_views(rows.column(1))), end_id)
                n = np.diff(ends, prepend=0)
                yield pa.RecordBatch.from_arrays([rows.column(0), int_lists(ids.astype(np.int32), ends), pa.array(n, pa.int64()), pa.array(np.full(len(n), part), pa.int32()), pa.array(total + ends - n, pa.int64())], names=[id_col, "ids", "n_tokens", "part", "start_in_part"])
                total += int(ends[-1])

    schema = T.StructType([df.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("start_in_part", T.LongType())])
    options = {"parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes, "parquet.writer.version": "v2", "parquet.enable.dictionary": "true"}
    options |= {f"parquet.enable.dictionary#{c}": "false" for c in (id_col, "n_tokens", "start_in_part")}
    dealt = df.select(id_col, text_col).repartitionByRange(id_col).sortWithinPartitions(id_col)
    dealt.mapInArrow(run, schema).write.options(**{k: str(v) for k, v in options.items()}).parquet(out)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``start``: how many tokens all documents before have. Only the metadata columns are read for it.

    The sums by part are one row for each file, however large the files are."""
    rows = spark.read.parquet(path)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("start_in_part")).drop("base", "part", "start_in_part")


def checksums(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of rows of ``read_tokens``: unsigned crc32 of the ids as little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = [crc_ids(x.values.to_numpy(zero_copy_only=False)) for x in batch.column(3)]
            sizes = pc.list_value_length(batch.column(3)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, pa.array(crc, pa.int64())], names=[id_col, "start", "n_tokens", "ids_crc32"])

    schema = T.StructType([tokens.schema[id_col], T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    return tokens.select(id_col, "start", "n_tokens", "ids").mapInArrow(run, schema)
