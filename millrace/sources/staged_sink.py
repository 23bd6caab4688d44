"""A stream sink of rolling part files with a choice of delivery guarantee.

Tasks write rows as CSV lines to part files that roll by rows, bytes or age, and report
the files they closed; the driver's commit publishes them.

* ``exactly_once``: files are staged.  The commit first writes what it will publish to a
  log entry named by the batch, in one rename, then moves the files.  A batch that is
  delivered again finds its entry: the moves are finished from the entry and the files of
  the second attempt are dropped.  A batch without an entry was never published.
* ``at_least_once``: files are staged and published by the commit under new names, without
  a log: a batch delivered again is published again.
* ``none``: files are written where readers see them; those of failed attempts stay.

Part files are named ``<prefix>-<batch>-<number><suffix>`` (under ``none`` and
``at_least_once`` the number is a random name).  The folder is any that Arrow's file
systems reach from both driver and executors.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import csv, fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

from millrace.scratch import new_folder
from millrace.streaming.runner import stream_settings

GUARANTEES = ("exactly_once", "at_least_once", "none")


@dataclass
class Parts(WriterCommitMessage):
    """Closed files of one task, in the order they were written."""

    paths: list[str]


@dataclass(frozen=True)
class Roll:
    """When a part file is full; None sets no bound."""

    rows: int | None = None
    nbytes: int | None = None
    seconds: float | None = None

    def room(self, rows: int) -> int | None:
        """Rows that still fit by count."""
        return None if self.rows is None else self.rows - rows

    def due(self, rows: int, nbytes: int, age: float) -> bool:
        held = ((rows, self.rows), (nbytes, self.nbytes), (age, self.seconds))
        return any(bound is not None and x >= bound for x, bound in held)


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


class PartWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.folder = options["path"].rstrip("/")
        self.guarantee = options.get("guarantee", GUARANTEES[0])
        if self.guarantee not in GUARANTEES:
            raise ValueError(f"guarantee is one of {GUARANTEES}")
        self.prefix, self.suffix = options.get("prefix", "part"), options.get("suffix", ".csv")
        bounds = [options.get(k) for k in ("rollrows", "rollbytes", "rollseconds")]
        self.roll = Roll(*(cast(b) if b else None for cast, b in zip((int, int, float), bounds)))

    # --- tasks ---
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        system, base = file_system(self.folder)
        place = f"{base}/data" if self.guarantee == "none" else f"{base}/_staged"
        system.create_dir(place, recursive=True)
        paths, out, sink, rows, opened = [], None, None, 0, 0.0

        def shut() -> None:
            out.close()
            sink.close()

        for batch in iterator:
            while batch.num_rows:
                if out is None:
                    paths.append(f"{place}/{self.prefix}-{uuid.uuid4().hex}{self.suffix}")
                    sink, rows, opened = system.open_output_stream(paths[-1]), 0, time.monotonic()
                    out = csv.CSVWriter(sink, batch.schema, write_options=csv.WriteOptions(include_header=False))
                room = self.roll.room(rows)
                part = batch if room is None else batch.slice(0, room)
                out.write_batch(part)
                rows += part.num_rows
                batch = batch.slice(part.num_rows)
                if self.roll.due(rows, sink.tell(), time.monotonic() - opened):
                    shut()
                    out = None
        if out is not None:
            shut()
        return Parts(paths)

    # --- driver ---
    def commit(self, messages: list[Parts | None], batchId: int) -> None:
        system, base = file_system(self.folder)
        paths = [p for m in messages if m is not None for p in m.paths]
        if self.guarantee == "none":
            return
        system.create_dir(f"{base}/data", recursive=True)
        if self.guarantee == "at_least_once":
            for p in paths:
                system.move(p, f"{base}/data/{self.prefix}-{batchId}-{uuid.uuid4().hex}{self.suffix}")
            return
        entry = f"{base}/_log/{batchId:012d}.json"
        if _exists(system, entry):
            with system.open_input_stream(entry) as f:
                published = json.loads(f.read())
            for p in paths:
                system.delete_file(p)
        else:
            published = [[p, f"{base}/data/{self.prefix}-{batchId}-{i}{self.suffix}"] for i, p in enumerate(paths)]
            system.create_dir(f"{base}/_log", recursive=True)
            draft = f"{base}/_staged/{uuid.uuid4().hex}.json"
            system.create_dir(f"{base}/_staged", recursive=True)
            with system.open_output_stream(draft) as f:
                f.write(json.dumps(published).encode())
            system.move(draft, entry)
        for staged, final in published:
            if _exists(system, staged):
                system.move(staged, final)

    def abort(self, messages: list[Parts | None], batchId: int) -> None:
        if self.guarantee == "none":
            return
        system, base = file_system(self.folder)
        if _exists(system, f"{base}/_log/{batchId:012d}.json"):
            return  # the entry names its files: the next delivery finishes the moves
        for p in (p for m in messages if m is not None for p in m.paths):
            if _exists(system, p):
                system.delete_file(p)


def _exists(system: fs.FileSystem, path: str) -> bool:
    return system.get_file_info(path).type != fs.FileType.NotFound


class PartFiles(DataSource):
    """``writeStream.format("part_files")`` with path, guarantee, prefix, suffix, rollRows, rollBytes, rollSeconds."""

    @classmethod
    def name(cls) -> str:
        return "part_files"

    def streamWriter(self, schema, overwrite: bool) -> PartWriter:
        return PartWriter({k.lower(): v for k, v in self.options.items()})


class _FailsOnce(PartWriter):
    """Loses its first commit of the run, before or after the files are published."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.when = options["failonce"]

    def commit(self, messages: list[Parts | None], batchId: int) -> None:
        system, base = file_system(self.folder)
        mark = f"{base}/_failed"
        if _exists(system, mark):
            super().commit(messages, batchId)
            return
        if self.when == "after":
            super().commit(messages, batchId)
        system.create_dir(base, recursive=True)
        with system.open_output_stream(mark) as f:
            f.write(b"")
        raise RuntimeError("lost at commit")


class FaultyPartFiles(PartFiles):
    """The same sink with ``failOnce`` = before or after, to rehearse a lost driver."""

    @classmethod
    def name(cls) -> str:
        return "faulty_part_files"

    def streamWriter(self, schema, overwrite: bool) -> PartWriter:
        return _FailsOnce({k.lower(): v for k, v in self.options.items()})


def run_part_files(stream: DataFrame, label: str, folder: str | None = None, **options: str) -> str:
    """Run to completion into part files; the folder that readers read.  A given ``folder`` is resumed."""
    spark: SparkSession = stream.sparkSession
    source = FaultyPartFiles if "failOnce" in options else PartFiles
    spark.dataSource.register(source)
    base = folder or new_folder(spark, label)
    with stream_settings(spark):
        query = (
            stream.writeStream.format(source.name())
            .options(**options)
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{base}/out")
        )
        query.awaitTermination()
    return f"{base}/out/data"
