"""Matrices in ``.npy`` files as a Spark data source.

``register(spark)`` once; then ``read(spark, path)`` or ``spark.read.format("npy").load(path)``, and ``df.write.format("npy").save(path)``. A file is
read in as many partitions as its rows need, each of which seeks to its first row and reads a few megabytes at a time. Files are opened with
pyarrow on the executors, so their store must be one that pyarrow knows; for others, ``readers.matrix`` loads whole files through Spark.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from .staging import StagedWriter, filesystem

SCHEMA = "file string, position long, vector array<float>"
PARTITION_BYTES, BATCH_BYTES, FILE_BYTES = 64 << 20, 4 << 20, 64 << 20
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


class Header:
    """Shape, type and place of the data of one file; an error for what isn't a whole matrix of numbers in row order."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.path = path
        with store.open_input_file(path) as f:
            version = np.lib.format.read_magic(f)
            if version not in ((1, 0), (2, 0)):
                raise ValueError(f"{path}: .npy version {version} isn't supported")
            shape, by_column, dtype = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(f)
            self.offset = f.tell()
            size = f.size()
        if len(shape) != 2 or by_column or dtype.kind not in "fiu":
            raise ValueError(f"{path}: shape {shape} of {dtype}{' by columns' if by_column else ''} isn't a matrix of numbers by rows")
        (self.rows, self.width), self.dtype = shape, dtype
        self.row_bytes = self.width * dtype.itemsize
        if self.offset + self.rows * self.row_bytes > size:
            raise ValueError(f"{path}: {size} bytes are too few for {self.rows} rows of {self.width} {dtype}")


class Rows(InputPartition):
    """Rows ``start`` to before ``stop`` of a file whose first row has position ``base``."""

    def __init__(self, header: Header, base: int, start: int, stop: int):
        self.header, self.base, self.start, self.stop = header, base, start, stop


class NpyReader(DataSourceReader):
    def __init__(self, path: str, partition_bytes: int):
        self.path, self.bytes = path, partition_bytes
        self.low, self.high = 0, 1 << 62  # positions that are asked for

    def partitions(self) -> list[Rows]:
        store, path = filesystem(self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        paths = [path] if info.type == fs.FileType.File else sorted(f.path for f in store.get_file_info(fs.FileSelector(path)) if f.path.endswith(".npy"))
        out, base = [], 0
        for p in paths:
            h = Header(store, p)
            step = max(1, self.bytes // max(1, h.row_bytes))
            first, last = max(0, self.low - base), min(h.rows, self.high - base)
            out += [Rows(h, base, a, min(a + step, last)) for a in range(first, last, step)]
            base += h.rows
        return out

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no partition at all
            return
        h, step = partition.header, max(1, BATCH_BYTES // max(1, partition.header.row_bytes))
        store, _ = filesystem(self.path)
        with store.open_input_file(h.path) as f:
            f.seek(h.offset + partition.start * h.row_bytes)
            for a in range(partition.start, partition.stop, step):
                n = min(step, partition.stop - a)
                values = np.frombuffer(f.read(n * h.row_bytes), dtype=h.dtype).astype(np.float32)
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * h.width), pa.array(values))
                yield pa.RecordBatch.from_arrays([pa.array([h.path] * n), pa.array(np.arange(a, a + n) + partition.base), vectors], names=["file", "position", "vector"])


class PruningNpyReader(NpyReader):
    """Reads only the partitions that a filter on ``position`` can pass. The filters stay with Spark as well."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) == ("position",) and isinstance(getattr(f, "value", None), int):
                if isinstance(f, (EqualTo, GreaterThanOrEqual, GreaterThan)):
                    self.low = max(self.low, f.value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThanOrEqual, LessThan)):
                    self.high = min(self.high, f.value + (not isinstance(f, LessThan)))
            yield f


class NpyWriter(StagedWriter):
    """One or more files a task, of at most about ``FILE_BYTES``; read again, they come in the order of tasks, each in the order of its rows."""

    def files(self, batches: Iterator[pa.RecordBatch], task: int) -> Iterator[tuple[str, bytes, int]]:
        held: list[np.ndarray] = []
        size = number = 0

        def flush() -> tuple[str, bytes, int]:
            out, m = io.BytesIO(), np.concatenate(held)
            np.lib.format.write_array(out, m, version=(1, 0), allow_pickle=False)
            return f"part-{task:06d}-{number:06d}.npy", out.getvalue(), len(m)

        for batch in batches:
            column = batch.column("vector")
            lengths = set(column.value_lengths().to_pylist())
            if column.null_count or column.flatten().null_count or len(lengths) > 1 or (held and batch.num_rows and lengths != {held[0].shape[1]}):
                raise ValueError("vectors must be there, without nulls and all of one width")
            if batch.num_rows:
                m = column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(batch.num_rows, -1)
                held.append(m)
                size += m.nbytes
            if size >= FILE_BYTES:
                yield flush()
                held, size, number = [], 0, number + 1
        if held:
            yield flush()


class NpySource(DataSource):
    """Option ``partitionBytes``: bytes of a partition. Files of a folder count as one matrix in the order of their names."""

    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        kind = PruningNpyReader if self.options.get("pushdown", "").lower() == "true" else NpyReader
        return kind(self.options["path"], int(self.options.get("partitionBytes", PARTITION_BYTES)))

    def writer(self, schema: StructType, overwrite: bool) -> NpyWriter:
        if "vector" not in schema.names:
            raise ValueError("a column named vector is written")
        return NpyWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NpySource)


def read(spark: SparkSession, path: str, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(file, position, vector) of one file or a folder's files. Filters on position prune partitions where the session allows Python sources to
    take filters (``PUSHDOWN``)."""
    register(spark)
    pushes = (spark.conf.get(PUSHDOWN, "false") or "false").lower()
    return spark.read.format("npy").option("partitionBytes", partition_bytes).option("pushdown", pushes).load(path)
