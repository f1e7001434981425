"""Payloads as files in class folders, ``split/label/name``, and what is there afterwards.

``register(spark)`` once; then ``df.write.format("classfolders").save(path)``. The folders appear when all files are there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource
from pyspark.sql.types import BinaryType, StructType

from ..operators import reconcile
from ..operators.reconcile import CountMismatch
from .staging import StagedWriter

COLUMNS = ("split", "label", "id", "key", "payload")


def suffix(name: str) -> str:
    """From the last dot on; a name that starts with its only dot has none."""
    base = name.rpartition("/")[2]
    stem, dot, rest = base.rpartition(".")
    return dot + rest if stem and rest else ""


def file_name(id_col: Column, key: Column) -> Column:
    """The name that a row's file gets, as a column: 16 digits of the id's digest, and the key's suffix."""
    return F.concat(F.substring(F.sha1(id_col.cast("string").cast("binary")), 1, 16), F.regexp_extract(F.element_at(F.split(key, "/"), -1), r"(?s).(\.[^.]+)$", 1))


class FolderWriter(StagedWriter):
    def files(self, batches: Iterator[pa.RecordBatch], task: int) -> Iterator[tuple[str, bytes, int]]:
        for batch in batches:
            for split, label, identity, key, payload in zip(*(batch.column(c).to_pylist() for c in COLUMNS)):
                if payload is None:
                    raise FileNotFoundError(f"{identity}: no payload")
                for part in (split, label):
                    if part in (None, "", ".", "..") or "/" in part or part.startswith("_"):
                        raise ValueError(f"{identity}: {part!r} can't be a folder's name")
                name = hashlib.sha1(str(identity if identity is not None else key).encode()).hexdigest()[:16] + suffix(key or str(identity))
                yield f"{split}/{label}/{name}", payload, 1


class FolderSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "classfolders"

    def writer(self, schema: StructType, overwrite: bool) -> FolderWriter:
        missing = [c for c in COLUMNS if c not in schema.names]
        if missing or not isinstance(schema["payload"].dataType, BinaryType):
            raise ValueError(f"columns {', '.join(COLUMNS)} are written, with a binary payload; missing: {', '.join(missing) or 'none'}")
        return FolderWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FolderSource)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(split, label, name, path, length) of the files in class folders; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    parts = F.split("path", "/")
    decoded = lambda i: F.url_decode(F.replace(F.element_at(parts, i), F.lit("+"), F.lit("%2B")))
    found = files.select(decoded(-3).alias("split"), decoded(-2).alias("label"), decoded(-1).alias("name"), "path", "length")
    return found.where(~F.col("name").startswith("_"))


def write(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write (split, label, id, key, payload) and compare the files with the rows. A row without payload is an error; so is an id that comes
    twice in one class, as its rows would be one file: both are found before or after the write, and then the folder isn't trusted."""
    register(df.sparkSession)
    rows = df.select(F.col("split").cast("string"), F.col("label").cast("string"), F.col("id").cast("string"), F.col("key").cast("string"), "payload")
    rows.write.format("classfolders").mode("overwrite" if overwrite else "append").save(path)
    wrong = reconcile.counts_agree(df, listing(df.sparkSession, path), ("split", "label")).orderBy("split", "label").limit(5).collect()
    if wrong:
        raise CountMismatch("; ".join(f"{r['split']}/{r['label']}: {r['expected']} rows, {r['copied']} files" for r in wrong))
