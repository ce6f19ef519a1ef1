"""What the text operators share: reading, storing, texts out of Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.session import scratch_path

LOWEST = -(2 ** 63)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write to the shared folder and read back: a lost executor then costs a task, not the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_place(df: DataFrame, own: Iterable[str], made: Iterable[str] = ()) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns, but for ``own``, named by their place, and the names to give back by ``by_name``.

    An operator's own helper columns then clash with none, and names with dots or signs need no quotes.
    Columns named like those in ``made``, which the operator adds, are left out.
    """
    own, made = set(own), set(made)
    places = [c if c in own else f"__c{i}" for i, c in enumerate(df.columns)]
    kept = [p for p, c in zip(places, df.columns) if c in own or c not in made]
    return df.toDF(*places).select(*kept), dict(zip(places, df.columns))


def by_name(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.toDF(*[names.get(c, c) for c in df.columns])


def order_id(name: str = "doc_id") -> Column:
    """The id as an order without nulls; a null id comes before all others."""
    return F.coalesce(F.col(name).cast("long"), F.lit(LOWEST))


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as bytes; null is empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]


_REMEMBERED: dict = {}


def trim() -> None:
    """Give memory no longer in use back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back:
        give_back(0)


def forget() -> None:
    """Drop what the worker remembers and give its memory back to the system."""
    if _REMEMBERED:
        _REMEMBERED.clear()
        trim()


def remembered(key, make: Callable):
    """What a worker process keeps between tasks, of one kind at a time: another key drops it."""
    if key not in _REMEMBERED:
        forget()
        _REMEMBERED[key] = make()
    return _REMEMBERED[key]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000, keep: bool = False) -> Iterator[pa.RecordBatch]:
    """Batches in parts, so that a task holds few texts at a time; unless told to keep it, what the
    worker remembers for another kind of task goes first."""
    if not keep:
        forget()
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def spans(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cut a list of sizes into ranges of about ``limit`` in all; a larger one stands alone."""
    start, held, i = 0, 0, -1
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start <= i:
        yield start, i + 1


def by_bytes(texts: list, limit: int) -> Iterator[tuple[int, int]]:
    """Cut a list into ranges of about ``limit`` bytes; a longer text stands alone."""
    return spans(map(len, texts), limit)
