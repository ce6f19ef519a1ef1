"""Writing to a sink that may refuse rows by rules only it knows, and getting just those rows back.

A sink is an object (``RowSink``) with a transaction per task attempt. It is written to by a Spark data source
writer: tasks hand rows over in batches and prepare, the driver commits what the successful attempts prepared, and
nothing of a failed or repeated attempt counts, neither its rows nor its refusals. Refused rows go from the tasks
to files in the shared folder; only the names of those files travel with the commit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from rowmill.session import scratch_path

BATCH_ROWS = 100
_ROW = "__row"
# Whole microseconds, so that a refused row comes back as it went.
_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
Refusal = tuple[str, str]


class RowSink:
    """What a sink offers. A copy of it works in every task; ``commit`` and ``abort`` run once, on the driver."""

    def begin(self, attempt: str) -> None:
        """Start the transaction of one task attempt."""

    def put(self, rows: Sequence[Row]) -> list[Refusal | None]:
        """Take a batch: for each row None, or why it is refused (code, message)."""
        raise NotImplementedError

    def prepare(self) -> str:
        """Make the attempt's rows ready; what ``commit`` needs to find them."""
        return ""

    def commit(self, prepared: Sequence[str]) -> None:
        """Make the rows of all successful attempts visible, in one step if the sink can."""

    def abort(self, prepared: Sequence[str]) -> None:
        """Drop what was prepared."""


def _local(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _write_text(path: str, lines: Sequence[str]) -> None:
    system, at = _local(path)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(at) as out:
        out.write("".join(f"{line}\n" for line in lines).encode())


@dataclass
class _Done(WriterCommitMessage):
    prepared: str
    refused: str | None


class _Writer(DataSourceWriter):
    def __init__(self, sink: RowSink, folder: str, batch_rows: int):
        self.sink, self.folder, self.batch_rows = sink, folder, batch_rows

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        attempt, refused = uuid.uuid4().hex, []
        self.sink.begin(attempt)
        while batch := list(islice(iterator, self.batch_rows)):
            rows = [Row(*r.__fields__[:-1])(*r[:-1]) for r in batch]
            for row, why in zip(batch, self.sink.put(rows), strict=True):
                if why is not None:
                    refused.append(json.dumps({"row": row[_ROW], "errorCode": why[0], "errorMessage": why[1]}))
        if refused:
            _write_text(f"{self.folder}/refused/{attempt}.txt", refused)
        return _Done(self.sink.prepare(), attempt if refused else None)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        done = [m for m in messages if m is not None]
        self.sink.commit([m.prepared for m in done])
        _write_text(f"{self.folder}/committed.txt", [m.refused for m in done if m.refused])

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.sink.abort([m.prepared for m in messages if m is not None])


def write_to_sink(df: DataFrame, sink: RowSink, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Write ``df`` to ``sink``; the rows it refused, with ``errorCode`` and ``errorMessage``.

    The shared folder must be one that Python can open too (a path, file or hdfs address). A task's refused rows are held until its end.
    """
    spark, kind, folder = df.sparkSession, f"rowmill_{uuid.uuid4().hex}", scratch_path(df.sparkSession, "refused")

    class Target(DataSource):
        @classmethod
        def name(cls) -> str:
            return kind

        def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
            return _Writer(sink, folder, batch_rows)

    spark.dataSource.register(Target)
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), _JSON)
    df.withColumn(_ROW, whole).write.format(kind).mode("append").save()
    names = spark.read.text(f"{folder}/committed.txt").select("value")
    kinds = T.StructType([T.StructField(n, T.StringType()) for n in ("row", "errorCode", "errorMessage")])
    if names.isEmpty():
        lines = spark.createDataFrame([], kinds)
    else:
        found = spark.read.text(f"{folder}/refused").select("value", F.regexp_extract("_metadata.file_name", "^(.*)[.]txt$", 1).alias("file"))
        held = found.join(F.broadcast(names.toDF("file")), "file", "left_semi")
        lines = held.select(F.from_json("value", kinds).alias("r")).select("r.*")
    back = lines.select(F.from_json("row", df.schema, _JSON).alias("row"), "errorCode", "errorMessage")
    return back.select("row.*", "errorCode", "errorMessage")


class FileSink(RowSink):
    """Rows as Parquet files in a folder, one a task, each checked by ``refuse`` as it comes.

    Files are prepared beside the folder and moved into it by the commit.
    """

    def __init__(self, folder: str, schema: T.StructType, refuse: Callable[[Row], Refusal | None]):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.folder, self.refuse, self.schema = folder.rstrip("/"), refuse, to_arrow_schema(schema)

    def begin(self, attempt: str) -> None:
        self.attempt, self.rows = attempt, []

    def put(self, rows: Sequence[Row]) -> list[Refusal | None]:
        answers = [self.refuse(r) for r in rows]
        self.rows += [tuple(r) for r, why in zip(rows, answers) if why is None]
        return answers

    def prepare(self) -> str:
        system, at = _local(f"{self.folder}__prepared/{self.attempt}.parquet")
        system.create_dir(at.rsplit("/", 1)[0], recursive=True)
        columns = list(zip(*self.rows)) or [()] * len(self.schema)
        with system.open_output_stream(at) as out:
            pq.write_table(pa.table([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema), out)
        return self.attempt

    def commit(self, prepared: Sequence[str]) -> None:
        for attempt in prepared:
            system, source = _local(f"{self.folder}__prepared/{attempt}.parquet")
            _, target = _local(f"{self.folder}/{attempt}.parquet")
            system.create_dir(target.rsplit("/", 1)[0], recursive=True)
            system.move(source, target)

    def abort(self, prepared: Sequence[str]) -> None:
        """Nothing was shown; what was prepared stays beside the folder for the caller to remove."""
