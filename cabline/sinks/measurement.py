"""Committed measurement sink: a Python data source that writes point lines in batches.

Each task writes its lines as staged objects of at most ``batch`` lines; the driver's commit
moves the objects of the tasks that Spark accepted into the database's folder, and an abort
removes what was staged.  So a failed job, a repeated or a speculative task leaves no
line behind, and a streaming batch that is replayed replaces its own objects.  (What a lost
task of a stream had staged stays in a folder ``_staging-...``, which readers skip.)

    spark.dataSource.register(MeasurementSource)
    lines.write.format("measurement").option("path", base).option("db", "sineWave").mode("append").save()

``lines`` has one string column, as ``line_protocol(...).select("line")`` gives it.  The folder
is reached through pyarrow's file systems (local, HDFS, object stores), by tasks and driver
alike, so on a cluster it must be a shared one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter,
                                    WriterCommitMessage)

from cabline._shipping import ship_by_value

ship_by_value(__name__)         # runs inside Python workers without an installed package

# Points of one batch and default database name of the original sink.
BATCH_POINTS = 2000
DEFAULT_DATABASE = "sineWave"


@dataclass
class Staged(WriterCommitMessage):
    folder: str             # of the writer that the task had: a stream's commit has its own
    objects: list[str]


class _Writer:
    def __init__(self, options: dict, overwrite: bool) -> None:
        if not options.get("path"):
            raise ValueError("option path: the base folder of the databases")
        self.files, base = fs.FileSystem.from_uri(options["path"]) if "://" in options["path"] \
            else (fs.LocalFileSystem(), options["path"])
        self.folder = f"{base.rstrip('/')}/{options.get('db', DEFAULT_DATABASE)}"
        self.batch = int(options.get("batch", BATCH_POINTS))
        if self.batch < 1:
            raise ValueError("option batch: at least one point")
        self.staging = f"{self.folder}/_staging-{uuid.uuid4().hex}"
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        context = TaskContext.get()
        # attempts of one task never share an object
        task = f"{context.partitionId():05d}-{context.taskAttemptId()}"
        objects: list[str] = []
        held: list[str] = []

        def send(lines: list[str]) -> None:
            name = f"{task}-{len(objects):06d}.txt"
            with self.files.open_output_stream(f"{self.staging}/{name}") as out:
                out.write(("\n".join(lines) + "\n").encode())
            objects.append(name)

        self.files.create_dir(self.staging, recursive=True)
        for b in iterator:
            held += b.column(0).to_pylist()
            while len(held) >= self.batch:
                send(held[:self.batch])
                held = held[self.batch:]
        if held:
            send(held)
        return Staged(self.staging, objects)

    def _drop(self, messages: list) -> None:
        for folder in {self.staging, *(m.folder for m in messages if m is not None)}:
            if self.files.get_file_info(folder).type == fs.FileType.Directory:
                self.files.delete_dir(folder)

    def _publish(self, messages: list, prefix: str) -> None:
        """Moves the accepted objects in; the ones that were there under ``prefix`` go."""
        self.files.create_dir(self.folder, recursive=True)
        for old in self.files.get_file_info(fs.FileSelector(self.folder)):
            if old.type == fs.FileType.File and self._replaced(old.base_name, prefix):
                self.files.delete_file(old.path)
        for message in messages:
            for name in message.objects if message is not None else ():
                self.files.move(f"{message.folder}/{name}", f"{self.folder}/{prefix}{name}")
        self._drop(messages)

    def _replaced(self, name: str, prefix: str) -> bool:
        raise NotImplementedError


class PointWriter(_Writer, DataSourceArrowWriter):
    def _replaced(self, name: str, prefix: str) -> bool:
        return self.overwrite

    def commit(self, messages: list) -> None:
        self._publish(messages, f"run-{uuid.uuid4().hex[:12]}-")

    def abort(self, messages: list) -> None:
        self._drop(messages)


class PointStreamWriter(_Writer, DataSourceStreamArrowWriter):
    def _replaced(self, name: str, prefix: str) -> bool:
        return name.startswith(prefix)      # a replayed batch

    def commit(self, messages: list, batchId: int) -> None:
        self._publish(messages, f"batch-{batchId:012d}-")

    def abort(self, messages: list, batchId: int) -> None:
        self._drop(messages)


class MeasurementSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "measurement"

    def writer(self, schema, overwrite: bool) -> PointWriter:
        return PointWriter(dict(self.options), overwrite)

    def streamWriter(self, schema, overwrite: bool) -> PointStreamWriter:
        return PointStreamWriter(dict(self.options), overwrite)
