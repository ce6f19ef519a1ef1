"""Hot keys: find them with a sketch of fixed size, and keep them off single tasks.

A key is hot when it holds more than ``share`` of all rows. Fewer than ``1 / share`` keys can do so
whatever the data, so the list of hot keys is a broadcast of at most ``1 / share`` eight-byte
hashes. A hash collision only sends a cold key down the hot path, which is right for every key.
The input is read again for each pass: it has to give the same rows each time (a file scan does; put
a ``checkpoint()`` or a written table after a sample or an unordered limit).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

HOT_SHARE = 1e-5
HOT_ROWS = 1_000_000
SALTS = 16_384

_HOT, _CELL = "__hot", "__cell"
MOST_CELLS = 1 << 20


def sketch_cells(share: float) -> int:
    """Cells of the sketch: eight for each key that could be hot, so that cold keys seldom fill one."""
    return min(MOST_CELLS, 1 << max(6, math.ceil(math.log2(8 / max(share, 1e-9)))))


def hot_hashes(df: DataFrame, keys: Sequence[Column], share: float, rows: int) -> DataFrame:
    """Hashes of the keys that hold more than ``share`` of the rows and at least ``rows`` of them.

    Count-min: rows are counted by cell, a part of the key's hash, so a task passes on at most one record a
    cell, however many keys it sees, and cells are summed in parallel. A hot key makes its cell heavy. Only the keys in
    heavy cells, fewer than ``1 / share`` of them, are then counted one by one; without any, nothing is.
    """
    hashed = df.select(F.xxhash64(*keys).alias(_HOT))
    hashed = hashed.withColumn(_CELL, F.pmod(F.col(_HOT), F.lit(sketch_cells(share))).cast("int"))
    cells = hashed.groupBy(_CELL).agg(F.count(F.lit(1)).alias("__rows"))
    total = cells.agg(F.sum("__rows").alias("__total")).scalar()
    hot = (F.col("__rows") >= rows) & (F.col("__rows") > F.lit(share) * total)
    heavy = cells.filter(hot).select(_CELL)
    counts = (hashed.join(F.broadcast(heavy), _CELL, "left_semi")
              .groupBy(_HOT).agg(F.count(F.lit(1)).alias("__rows")))
    return counts.filter(hot).select(_HOT)


def split_hot(df: DataFrame, keys: Sequence[Column], share: float, rows: int
              ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(cold rows, hot rows, hot hashes)``; both row sets keep the columns of ``df``."""
    hot = hot_hashes(df, keys, share, rows)
    hashed = df.withColumn(_HOT, F.xxhash64(*keys))
    cold = hashed.join(F.broadcast(hot), _HOT, "left_anti").drop(_HOT)
    warm = hashed.join(F.broadcast(hot), _HOT, "left_semi").drop(_HOT)
    return cold, warm, hot


def _holds_map(data_type: T.DataType) -> bool:
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return True
    if isinstance(data_type, T.ArrayType):
        return _holds_map(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_holds_map(f.dataType) for f in data_type.fields)
    return False


def comparable(df: DataFrame) -> list[str]:
    """Columns that can be ordered and hashed: all but maps."""
    return [f.name for f in df.schema.fields if not _holds_map(f.dataType)]


def salt(columns: Sequence[str], salts: int = SALTS) -> Column:
    """Spreads the rows of one key: by content, and for exact copies by where they were read.

    Both parts stay the same when a lost task is run again, in whatever order its rows arrive.
    """
    content = F.xxhash64(*[F.col(f"`{c}`") for c in columns]) if columns else F.lit(0)
    return F.pmod(content + F.spark_partition_id(), F.lit(salts))


def same_key(left: Sequence[Column], right: Sequence[Column], null_safe: bool) -> Column:
    pairs = [a.eqNullSafe(b) if null_safe else a == b for a, b in zip(left, right)]
    return reduce(lambda a, b: a & b, pairs)


MAX_ROWS = 1_000_000
MAX_BYTES = 64 * 1024 * 1024


def _bytes(field: T.StructField) -> Column:
    """The size of a value, near enough: text by its bytes, nested values by their JSON, others by width."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("long")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)).cast("long")
    return F.lit(8).cast("long")


def fits_in_memory(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Measure a table before it is broadcast: one aggregate over its rows and the size of their values."""
    size = reduce(lambda a, b: a + b, [_bytes(f) for f in df.schema.fields], F.lit(0).cast("long"))
    rows, held = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return rows <= max_rows and (held or 0) <= max_bytes


def join_unique(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                right_keys: Sequence[str], how: str, null_safe: bool = False,
                share: float | None = None, rows: int = HOT_ROWS, fits: bool = False,
                spread: int | None = None) -> DataFrame:
    """Equi-join with a right side that has each key once; ``how`` is left, inner, semi or anti.

    ``fits`` says that the right side was measured to fit in memory: it is broadcast, and the left
    side is read once and not shuffled. Otherwise both sides shuffle, unless one is bucketed by the keys, and adaptive
    execution splits the left rows of a hot key over tasks. With ``share`` (for sessions without it) hot keys of
    the left side are found first and meet a broadcast of the fewer than ``1 / share`` right rows
    that carry them. A left side in ``spread`` buckets by its keys stays as it is, and the right side is
    dealt out alike. The right key columns must not share names with the left ones.
    """
    kind = {"semi": "left_semi", "anti": "left_anti"}.get(how, how)

    def joined(side: DataFrame, other: DataFrame) -> DataFrame:
        on = same_key([side[f"`{c}`"] for c in left_keys], [other[f"`{c}`"] for c in right_keys],
                      null_safe)
        return side.join(other, on, kind)

    if fits:
        return joined(left, F.broadcast(right))
    if spread:
        return joined(left, right.repartition(spread, *[F.col(f"`{c}`") for c in right_keys]))
    if share is None:
        return joined(left, right)
    left_cols = [F.col(f"`{c}`") for c in left_keys]
    right_cols = [F.col(f"`{c}`") for c in right_keys]
    cold, warm, hot = split_hot(left, left_cols, share, rows)
    few = (right.withColumn(_HOT, F.xxhash64(*right_cols))
           .join(F.broadcast(hot), _HOT, "left_semi").drop(_HOT))
    return joined(cold, right).unionByName(joined(warm, F.broadcast(few)))
