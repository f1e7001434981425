"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
_kept: list[Callable] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``); a local one only where none is set, as in tests."""
    sc = spark.sparkContext
    set_to = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not set_to:
        set_to = sc.getCheckpointDir()
    if not set_to:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        set_to = tempfile.mkdtemp(prefix="sievework-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(set_to)
    return set_to


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str, compression: str | None = None) -> DataFrame:
    """Cut the lineage with a written table in the shared folder: a lost executor costs no recomputation."""
    spark, path = df.sparkSession, new_path(df.sparkSession, tag)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches to Python workers hold about ``BATCH_BYTES``, not 10,000 rows of any size, unless the user has set a
    bound. Executors keep a batch outside their heap and in the worker, and neither gives all of it back."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def whole_rows(df: DataFrame, id_col: str, text_col: str, whole: bool) -> tuple[DataFrame, list[T.StructField]]:
    """What an operator over texts sends to its workers, and the fields that come back as they went: the id beside the text, or, if
    ``whole``, one struct ``row`` of all columns, the text among them, so that each text travels once."""
    if not whole:
        return df.select(id_col, text_col), [df.schema[id_col]]
    return df.select(F.struct("*").alias("row")), [T.StructField("row", df.schema, False)]


def sent_text(batch: pa.RecordBatch, text_col: str, whole: bool) -> pa.Array:
    """The texts of a batch of ``whole_rows``."""
    return batch.column(0).field(text_col) if whole else batch.column(1)


def give_back() -> None:
    """Return memory that a batch has freed to the system, as worker processes live longer than their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries have no such call
        pass


def kept(cached: Callable) -> Callable:
    """Note a function with an ``lru_cache`` whose results stay in a worker beyond its task, for ``forget``."""
    _kept.append(cached)
    return cached


def forget() -> None:
    """Drop what tasks of other operators have left in this worker, which Spark reuses."""
    for cached in _kept:
        cached.cache_clear()
    give_back()


def text_views(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string or binary column, one value at a time without decoding; null gives b''."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = pa.large_binary() if wide else pa.binary()
    for value in column.cast(kind).to_pylist():
        yield value or b""


def slices_by_bytes(column: pa.Array, most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a column whose texts add up to about ``most`` bytes: bounds memory whatever the batch holds."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield start, i
            start, total = i, 0
        total += int(size)
    if start < len(sizes):
        yield start, len(sizes)


def int_lists(flat: np.ndarray, ends: np.ndarray, kind: pa.DataType = pa.int32()) -> pa.Array:
    """A list column from one flat array and each list's end."""
    offsets = np.zeros(len(ends) + 1, dtype=np.int32)
    offsets[1:] = ends
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))


def crc_of_text(column: str):
    """crc32 of an id written as text: the split between training and held-out rows."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def crc_ids(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash, elementwise on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def vectors_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, matrix in double precision) of the vectors that can take part: not null, no null or non-finite
    component, not zero, and of the batch's most common width."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows, vectors = [], []
    for i, value in enumerate(column.to_pylist() if column.null_count or column.values.null_count else column):
        if value is None:
            continue
        if isinstance(value, list):
            if any(x is None for x in value):
                continue
            value = np.array(value, dtype=np.float64)
        else:
            value = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if len(value) and np.isfinite(value).all() and value.any():
            rows.append(i)
            vectors.append(value)
    return np.array(rows, dtype=np.int64), vectors


class Numbers(dict):
    """Piece -> its number; a new piece gets the next number and is noted in ``fresh``.

    ``settle`` ends a batch: once there are ``most`` pieces, those of the batch go again. What is frequent came early and stays."""

    def __init__(self, most: int) -> None:
        self.most, self.fresh = most, []

    def __missing__(self, piece: bytes) -> int:
        n = self[piece] = len(self)
        self.fresh.append(piece)
        return n

    def numbered(self, pieces: list[bytes]) -> np.ndarray:
        self.fresh = []
        return np.fromiter(map(self.__getitem__, pieces), dtype=np.int64, count=len(pieces))

    def settle(self) -> int:
        """How many pieces stay; what is stored of later ones can go."""
        for piece in reversed(self.fresh):
            if len(self) <= self.most:
                break
            del self[piece]
        self.fresh = []
        return len(self)
