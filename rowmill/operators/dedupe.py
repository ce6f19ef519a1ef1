"""Unique and duplicate rows per key.

"First" needs an order in Spark: the caller's, then the ``tie_break`` columns, by default all others,
so that only exact copies tie and a repeated task picks the same rows again. Select the columns you
need before, or name the tie-break columns: all that take part are read, shuffled and compared.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowmill.operators.skew import HOT_ROWS, HOT_SHARE, SALTS, comparable, salt, split_hot

Order = Sequence[str | Column]
Case = bool | Mapping[str, bool]


def key_columns(df: DataFrame, keys: Sequence[str], case_sensitive: Case = True) -> list[Column]:
    """Key expressions; text keys marked case-insensitive compare in lower case."""
    kinds = dict(df.dtypes)
    out = []
    for key in keys:
        exact = case_sensitive if isinstance(case_sensitive, bool) else case_sensitive.get(key, True)
        column = F.col(f"`{key}`")
        out.append(column if exact or kinds[key] != "string" else F.lower(column))
    return out


def _exact(keys: Sequence[str], case_sensitive: Case) -> list[str]:
    """Keys whose columns are alike in all rows of a group; folded ones may differ in case."""
    if isinstance(case_sensitive, bool):
        return list(keys) if case_sensitive else []
    return [k for k in keys if case_sensitive.get(k, True)]


def full_order(df: DataFrame, keys: Sequence[str], order_by: Order, case_sensitive: Case = True,
               tie_break: Sequence[str] | None = None) -> list[Column]:
    """The wanted order, then the tie-break columns not yet in it."""
    wanted = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order_by]
    settled = {c for c in order_by if isinstance(c, str)} | set(_exact(keys, case_sensitive))
    rest = comparable(df) if tie_break is None else tie_break
    return wanted + [F.col(f"`{c}`") for c in rest if c not in settled]


def row_num(df: DataFrame, keys: Sequence[str], order_by: Order, name: str = "row_num",
            case_sensitive: Case = True, tie_break: Sequence[str] | None = None) -> DataFrame:
    """Number the rows of each key from 1.

    Filtered to ``name = k`` or ``name <= k`` the plan keeps k rows per key before its shuffle. The
    full numbering of a hot key is one task's work by nature; ``tag_duplicates`` needs none.
    """
    window = (Window.partitionBy(*key_columns(df, keys, case_sensitive))
              .orderBy(*full_order(df, keys, order_by, case_sensitive, tie_break)))
    return df.withColumn(name, F.row_number().over(window))


def _nth(df: DataFrame, keys: Sequence[str], order_by: Order, n: int, case_sensitive: Case,
         tie_break: Sequence[str] | None) -> DataFrame:
    numbered = row_num(df, keys, order_by, "__rn", case_sensitive, tie_break)
    return numbered.filter(F.col("__rn") == n).drop("__rn")


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Order, case_sensitive: Case = True,
                  tie_break: Sequence[str] | None = None) -> DataFrame:
    """The first row of each key. Every task passes on one row per key, so hot keys cost nothing."""
    return _nth(df, keys, order_by, 1, case_sensitive, tie_break)


def second_per_key(df: DataFrame, keys: Sequence[str], order_by: Order, case_sensitive: Case = True,
                   tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row for each key that repeats."""
    return _nth(df, keys, order_by, 2, case_sensitive, tie_break)


def tag_duplicates(df: DataFrame, keys: Sequence[str], order_by: Order, case_sensitive: Case = True,
                   route: str = "route", tie_break: Sequence[str] | None = None,
                   share: float = HOT_SHARE, rows: int = HOT_ROWS, salts: int = SALTS) -> DataFrame:
    """Every row with ``route`` = unique (the first of its key) or duplicate (the others).

    Cold keys take one shuffle by key. Rows of hot keys are numbered within salted shares of their
    key, then the first row of each share competes for the key: at most ``salts`` rows meet there.
    """
    exprs = key_columns(df, keys, case_sensitive)
    order = full_order(df, keys, order_by, case_sensitive, tie_break)
    cold, warm, _ = split_hot(df, exprs, share, rows)

    plain = cold.withColumn(
        "__first", F.row_number().over(Window.partitionBy(*exprs).orderBy(*order)) == 1)

    spread_by = (comparable(df) if tie_break is None else
                 [*dict.fromkeys([*(c for c in order_by if isinstance(c, str)), *tie_break])])
    shared = warm.withColumn("__salt", salt(spread_by, salts))
    shared = shared.withColumn(
        "__rn", F.row_number().over(Window.partitionBy(*exprs, "__salt").orderBy(*order)))
    shared = shared.withColumn(
        "__lane", F.when(F.col("__rn") == 1, F.lit(-1)).otherwise(F.col("__salt")))
    finalists = Window.partitionBy(*exprs, "__lane").orderBy(*order)
    salted = (shared.withColumn("__first", (F.row_number().over(finalists) == 1)
                                & (F.col("__lane") == -1))
              .drop("__salt", "__rn", "__lane"))

    return (plain.unionByName(salted)
            .withColumn(route, F.when(F.col("__first"), "unique").otherwise("duplicate"))
            .drop("__first"))


def uniq(df: DataFrame, keys: Sequence[str], order_by: Order, case_sensitive: Case = True,
         once: bool = False, tie_break: Sequence[str] | None = None, **skew) -> dict[str, DataFrame]:
    """``{"unique", "duplicate"}``; null keys form one group. ``once`` keeps one duplicate per key.

    The outputs are separate plans. To write both, write ``tag_duplicates`` once and read it back.
    """
    if not keys:
        raise ValueError("uniq needs at least one key column")
    if once:
        duplicate = second_per_key(df, keys, order_by, case_sensitive, tie_break)
    else:
        tagged = tag_duplicates(df, keys, order_by, case_sensitive, "__route", tie_break, **skew)
        duplicate = tagged.filter(F.col("__route") == "duplicate").drop("__route")
    return {"unique": first_per_key(df, keys, order_by, case_sensitive, tie_break),
            "duplicate": duplicate}


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Some row of each key, whichever comes first; only the keys are repeatable."""
    return df.dropDuplicates(list(keys))
