"""Rows to a store, with a commit: each row becomes visible once, or none does.

A plain `foreachPartition` hands rows over again when a task is retried or run twice. Here a task
stages its rows under the name of its attempt, and Spark's commit protocol decides: the driver
publishes the attempts that count, one for each partition, in one step; of failed jobs and of
attempts that lost nothing is ever seen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import islice
from typing import Protocol
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs, parquet
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark import files
from tidemark.operators.sinks import DEFAULT_BATCH_ROWS


class Store(Protocol):
    """A store that can hold rows back. It travels to other processes, and opens what it needs there."""

    def stage(self, job: str, attempt: str, number: int, rows: list[Row]) -> None:
        """On an executor: keep one batch of an attempt aside. Not called for empty partitions."""

    def publish(self, job: str, attempts: Sequence[str]) -> None:
        """Once all tasks are done: show all rows of these attempts, at once. A second call for the
        same job changes nothing. Spark calls this beside the driver, in a process without a session."""

    def discard(self, job: str) -> None:
        """After a failure, in the same place: drop what the job has staged."""


@dataclass
class _Staged(WriterCommitMessage):
    attempt: str
    rows: int


class _Writer(DataSourceWriter):
    def __init__(self, store: Store, job: str, batch_rows: int) -> None:
        self._store = store
        self._job = job
        self._batch_rows = batch_rows

    def write(self, iterator: Iterator[Row]) -> _Staged:
        attempt, total, number = uuid.uuid4().hex, 0, 0
        rows = iter(iterator)
        while chunk := list(islice(rows, self._batch_rows)):
            self._store.stage(self._job, attempt, number, chunk)
            total, number = total + len(chunk), number + 1
        return _Staged(attempt, total)

    def commit(self, messages: list[_Staged | None]) -> None:
        self._store.publish(self._job, sorted(m.attempt for m in messages if m is not None and m.rows))

    def abort(self, messages: list[_Staged | None]) -> None:
        self._store.discard(self._job)


def deliver(df: DataFrame, store: Store, *, job: str | None = None, batch_rows: int = DEFAULT_BATCH_ROWS) -> str:
    """Hand the rows of `df` to a store in batches, on the executors, and publish them together.

    `job` names the delivery; a caller that repeats a delivery after a failure of its own gives the
    same name, and a job that was published stays as it is. Returns the name.
    """
    job = job or uuid.uuid4().hex
    name = f"tidemark_delivery_{uuid.uuid4().hex}"

    class Delivery(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
            return _Writer(store, job, batch_rows)

    df.sparkSession.dataSource.register(Delivery)
    df.write.format(name).mode("append").save()
    return job


class StagedFolder:
    """A store of Parquet files in a folder that the driver and all executors share. What counts is
    listed in one small file per job, which appears whole or not at all."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType) -> None:
        self._spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    def __getstate__(self):
        return {"path": self.path, "schema": self.schema}

    def _system(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if urlparse(self.path).scheme else (fs.LocalFileSystem(), self.path)

    def stage(self, job: str, attempt: str, number: int, rows: list[Row]) -> None:
        system, root = self._system()
        system.create_dir(f"{root}/rows/{job}/{attempt}", recursive=True)
        table = pa.Table.from_pylist([r.asDict(recursive=True) for r in rows], to_arrow_schema(self.schema))
        parquet.write_table(table, f"{root}/rows/{job}/{attempt}/{number:08d}.parquet", filesystem=system)

    def publish(self, job: str, attempts: Sequence[str]) -> None:
        system, root = self._system()
        if self._published(job):
            return
        system.create_dir(f"{root}/jobs", recursive=True)
        draft = f"{root}/jobs/.{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as stream:
            stream.write(json.dumps(list(attempts)).encode())
        system.move(draft, f"{root}/jobs/{job}.json")

    def discard(self, job: str) -> None:
        system, root = self._system()
        if not self._published(job) and system.get_file_info(f"{root}/rows/{job}").type != fs.FileType.NotFound:
            system.delete_dir(f"{root}/rows/{job}")

    def _published(self, job: str) -> bool:
        system, root = self._system()
        return system.get_file_info(f"{root}/jobs/{job}.json").type != fs.FileType.NotFound

    def rows(self) -> DataFrame:
        """All published rows."""
        folders = []
        for name in files.names_in(self._spark, f"{self.path}/jobs"):
            if name.endswith(".json"):
                attempts = json.loads(files.read_text(self._spark, f"{self.path}/jobs/{name}"))
                folders += [f"{self.path}/rows/{name.removesuffix('.json')}/{attempt}" for attempt in attempts]
        if not folders:
            return self._spark.createDataFrame([], self.schema)
        return self._spark.read.schema(self.schema).parquet(*folders)
