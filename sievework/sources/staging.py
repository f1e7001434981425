"""Writers whose output appears as a whole or not at all.

Tasks write into a folder of their attempt beside the target and move what they finished into the job's folder; the driver renames that folder
when all tasks have ended. A task that fails removes its attempt, a job that fails its folder. The store must be one in which pyarrow can
rename (a shared or local file system, HDFS), and all executors must see it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path or URI, and the path within it."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


@dataclass
class Written(WriterCommitMessage):
    files: int
    rows: int


class StagedWriter(DataSourceArrowWriter):
    """``files`` turns a task's batches into (name, bytes, rows) of files; names may have folders."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path.rstrip("/"), overwrite, uuid.uuid4().hex
        store, target = filesystem(self.path)
        if not overwrite and store.get_file_info(target).type != fs.FileType.NotFound:
            raise FileExistsError(f"{path} exists")

    def files(self, batches: Iterator[pa.RecordBatch], task: int) -> Iterator[tuple[str, bytes, int]]:
        raise NotImplementedError

    @property
    def stage(self) -> str:
        target = filesystem(self.path)[1]
        folder, _, name = target.rpartition("/")
        return f"{folder}/.{name}-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, _ = filesystem(self.path)
        context = TaskContext.get()
        attempt = f"{self.stage}/_attempt-{context.partitionId()}-{context.taskAttemptId()}"
        names: dict[str, None] = {}
        folders: set[str] = set()
        rows = 0
        store.create_dir(attempt)
        try:
            for name, content, n in self.files(iterator, context.partitionId()):
                if name in names:
                    raise ValueError(f"two rows would be the file {name}")
                folder = name.rpartition("/")[0]
                if folder not in folders:
                    store.create_dir(f"{attempt}/{folder}")
                    folders.add(folder)
                with store.open_output_stream(f"{attempt}/{name}") as out:
                    out.write(content)
                names[name] = None
                rows += n
            for folder in folders:
                store.create_dir(f"{self.stage}/{folder}")
            for name in names:
                store.move(f"{attempt}/{name}", f"{self.stage}/{name}")
        finally:
            store.delete_dir(attempt)
        return Written(len(names), rows)

    def commit(self, messages: list[Written | None]) -> None:
        store, target = filesystem(self.path)
        store.create_dir(self.stage)
        found = [m for m in messages if m is not None]
        with store.open_output_stream(f"{self.stage}/_SUCCESS") as out:
            out.write(json.dumps({"files": sum(m.files for m in found), "rows": sum(m.rows for m in found)}).encode())
        if store.get_file_info(target).type != fs.FileType.NotFound:  # only with overwrite
            store.move(target, f"{self.stage}/_before")
        store.move(self.stage, target)
        if store.get_file_info(f"{target}/_before").type != fs.FileType.NotFound:
            store.delete_dir(f"{target}/_before")

    def abort(self, messages: list[Written | None]) -> None:
        store, _ = filesystem(self.path)
        if store.get_file_info(self.stage).type != fs.FileType.NotFound:
            store.delete_dir(self.stage)
