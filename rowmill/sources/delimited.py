"""Delimited text files with a fixed schema.

Lines are read whole and parsed as text columns first, then cast. So every row is checked in full
before any column is pruned, and a rejected row keeps its line. Fields cannot span lines, which
keeps files splittable. Compressed ``.gz`` and ``.bz2`` files read as they are.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from rowmill.functions.scalars import (
    LATIN1_CHARS, LATIN9_CHARS, decode_number, empty_to_null, from_latin9, plain_number, trim_field,
    typed)
from rowmill.operators.skew import join_unique
from rowmill.session import steady_splits

# The employee schema.
EMPLOYEE = T.StructType([
    T.StructField("ID", T.StringType()),
    T.StructField("NAME", T.StringType()),
    T.StructField("DEPT", T.StringType()),
    T.StructField("SAL", T.IntegerType()),
    T.StructField("AGE", T.StringType()),
])

_FIELDS = "__fields"
_WHOLE = "__whole"
_AT = "__at"
_BAD = "__bad"
_PLACE = ("__file", "__block", "__row")
FILES_IN_MEMORY = 100_000


def _placed(lines: DataFrame) -> DataFrame:
    """Where a line was read: its file, the start of its block, and its row within the task."""
    return lines.select("value", F.col("_metadata.file_path").alias(_PLACE[0]),
                        F.col("_metadata.file_block_start").alias(_PLACE[1]),
                        F.monotonically_increasing_id().alias(_PLACE[2]))


def _edge(placed: DataFrame, n: int, last: bool) -> DataFrame:
    """Per file, the place of its n-th line from one end; no more than n lines per task shuffle."""
    order = [F.col(c).desc() if last else F.col(c) for c in _PLACE[1:]]
    ranked = placed.withColumn("__rn", F.row_number().over(
        Window.partitionBy(_PLACE[0]).orderBy(*order))).filter(F.col("__rn") <= n)
    place = F.struct(*_PLACE[1:])
    return (ranked.groupBy(F.col(_PLACE[0]).alias("__edge_file"))
            .agg((F.min(place) if last else F.max(place)).alias("__edge")))


def skip_lines(lines: DataFrame, header: int = 0, footer: int = 0) -> DataFrame:
    """Drop the first and last lines of every file; a file of any size is never one task's work.

    The files are read twice, to find the edges and to drop them, and cut alike both times. The
    edges are a row per file; up to ``FILES_IN_MEMORY`` of them are broadcast.
    """
    steady_splits(lines.sparkSession)
    fits = len(lines.inputFiles()) <= FILES_IN_MEMORY
    placed = _placed(lines)
    out = placed
    for n, last in ((header, False), (footer, True)):
        if n > 0:
            joined = join_unique(out, _edge(placed, n, last), [_PLACE[0]], ["__edge_file"], "inner",
                                 fits=fits)
            place = F.struct(*_PLACE[1:])
            inside = place < F.col("__edge") if last else place > F.col("__edge")
            out = joined.filter(inside).drop("__edge_file", "__edge")
    return out.select("value")


def _decoded(value: Column, encoding: str) -> Column:
    kind = encoding.upper()
    if kind == "ISO-8859-15":
        return from_latin9(value)
    return value if kind in ("UTF-8", "US-ASCII") else F.decode(value.cast("binary"), encoding)


def _after_first_line(spark: SparkSession, paths: Sequence[str], encoding: str, row_sep: str
                      ) -> DataFrame:
    """Lines without each file's first one and without blank ones, by the reader itself.

    The file is read as a CSV of one column. A line that holds the separator counts as corrupt,
    and its text is then in the second column.
    """
    latin9 = encoding.upper() == "ISO-8859-15"
    rows = (spark.read.schema("value STRING, __whole STRING")
            .options(sep="\x01", quote="", escape="", header=True, lineSep=row_sep,
                     encoding="ISO-8859-1" if latin9 else encoding, mode="PERMISSIVE",
                     columnNameOfCorruptRecord="__whole").csv(list(paths)))
    line = F.coalesce("__whole", "value")
    return rows.select((F.translate(line, LATIN1_CHARS, LATIN9_CHARS) if latin9 else line)
                       .alias("value"))


def read_lines(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8",
               row_sep: str = "\n", header: int = 0, footer: int = 0,
               remove_empty: bool = True) -> DataFrame:
    """One ``value`` column, one row per line, decoded, without header and footer lines.

    Blank lines that are removed count for neither: the header is then the first line with anything on it, whichever
    way the file is read. One header line costs nothing. More header lines, or footers, have to be found first, by one
    more pass over the files for each.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if header == 1 and not footer and remove_empty and len(row_sep) == 1:
        lines = _after_first_line(spark, paths, encoding, row_sep)
    else:
        lines = spark.read.option("lineSep", row_sep).text(paths)
        if remove_empty:  # before lines are counted, as the reader does
            lines = lines.filter(trim_field(F.col("value")) != "")
        if header or footer:
            lines = skip_lines(lines, header, footer)
        lines = lines.select(_decoded(F.col("value"), encoding).alias("value"))
    return lines.filter(trim_field(F.col("value")) != "") if remove_empty else lines


def _text_fields(line: Column, names: Sequence[str], sep: str, csv: bool, quote: str,
                 escape: str) -> tuple[Column, Column]:
    """``(fields, whole)``: a struct of text fields, null where missing, and if the count is right.

    Both stand in one projection, which cuts a line once for all of them.
    """
    if not csv:
        parts = F.split(line, re.escape(sep), -1)
        fields = [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)]
        return F.struct(*fields), F.size(parts) == len(names)
    ddl = ", ".join(f"`{n}` STRING" for n in [*names, _BAD])
    parsed = F.from_csv(line, ddl, {"sep": sep, "quote": quote, "escape": escape,
                                    "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    return parsed, parsed[_BAD].isNull()


def _field(field: T.StructField, trim: bool, check_date: bool, thousands: str | None,
           decimal: str | None, decode: bool) -> tuple[Column, Column]:
    """A typed field and whether its text does not fit the type."""
    raw = F.col(f"{_FIELDS}.`{field.name}`")
    raw = F.when(F.col(_WHOLE), F.coalesce(raw, F.lit(""))).otherwise(raw)
    text = trim_field(raw) if trim else raw
    if isinstance(field.dataType, T.StringType):
        return text, F.lit(False)
    text = empty_to_null(text)
    if isinstance(field.dataType, T.NumericType):
        if decode:
            text = decode_number(text)
        if thousands or decimal:
            text = plain_number(text, thousands or "", decimal or ".")
    value = typed(text, field.dataType, (field.metadata or {}).get("pattern"))
    if isinstance(field.dataType, (T.DateType, T.TimestampType)) and not check_date:
        return value, F.lit(False)
    return value, text.isNotNull() & value.isNull()


def _tagged(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
            sep: str = "|", row_sep: str = "\n", header: int = 1, footer: int = 0,
            remove_empty: bool = True, trim_all: bool = True, trim_cols: Sequence[str] = (),
            encoding: str = "UTF-8", csv: bool = False, quote: str = '"', escape: str = '"',
            check_fields: bool = False, check_date: bool = False, thousands: str | None = None,
            decimal: str | None = None, decode_cols: Sequence[str] = (),
            split_record: str | None = None) -> DataFrame:
    lines = read_lines(spark, path, encoding, row_sep, header, footer, remove_empty)
    if split_record:
        lines = lines.select(F.explode_outer(F.split("value", re.escape(split_record))).alias("value"))
    fields, whole = _text_fields(F.col("value"), schema.names, sep, csv, quote, escape)
    rows = lines.select("value", fields.alias(_FIELDS), whole.alias(_WHOLE),
                        F.spark_partition_id().alias(_AT))
    typed_fields = {f.name: _field(f, trim_all or f.name in trim_cols, check_date, thousands,
                                   decimal, f.name in decode_cols) for f in schema.fields}
    wrong = F.concat_ws(";", *[F.when(bad, F.lit(f"{n}:type"))
                               for n, (_, bad) in sorted(typed_fields.items())])
    odd = ~F.col(_WHOLE) if check_fields else F.lit(False)
    return rows.select(*[value.alias(n) for n, (value, _) in typed_fields.items()],
                       F.col("value").alias("line"),
                       F.when(odd, "FIELDS").when(wrong != "", "TYPE").alias("errorCode"),
                       F.when(odd, f"expected {len(schema)} fields")
                       .otherwise(empty_to_null(wrong)).alias("errorMessage"), _AT)


def _where(tagged: DataFrame, test: Column) -> DataFrame:
    """Filter after parsing. The partition id in the test keeps Spark from moving it below: there it
    would parse every line again for the test, and meet lines that are still to be dropped."""
    return tagged.filter(F.when(test, F.col(_AT) >= 0).otherwise(F.lit(False))).drop(_AT)


def tag_delimited(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                  **options) -> DataFrame:
    """The typed columns with ``line``, ``errorCode`` and ``errorMessage``, null on good rows.

    Options, with their defaults: ``sep="|"``, ``row_sep="\\n"``, ``header=1`` and ``footer=0`` lines
    to skip in each file, ``remove_empty=True``, ``trim_all=True`` or ``trim_cols``,
    ``encoding="UTF-8"``, ``csv=False`` with ``quote`` and ``escape``, ``thousands`` and ``decimal``
    separators, ``decode_cols`` for hexadecimal and octal numbers, ``split_record`` to cut a line into
    several records. A row may fail by TYPE (dates only with ``check_date``) or, with
    ``check_fields``, by FIELDS; without it short rows get nulls and extra fields drop out.
    """
    return _tagged(spark, path, schema, **options).drop(_AT)


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                   limit: int | None = None, sample_n: int | None = None, seed: int = 0,
                   **options) -> DataFrame:
    """Good rows; a bad row ends the run, also when only some columns or a count are asked for."""
    tagged = _tagged(spark, path, schema, **options)
    problem = F.concat_ws(" ", "errorCode", "errorMessage", F.lit("in:"), "line")
    good = F.when(F.col("errorCode").isNull(), F.lit(True)).otherwise(
        F.raise_error(problem).cast("boolean"))
    return _some(_where(tagged, good).drop("line", "errorCode", "errorMessage"), limit, sample_n,
                 seed)


def read_with_rejects(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                      limit: int | None = None, sample_n: int | None = None, seed: int = 0,
                      **options) -> dict[str, DataFrame]:
    """``{"main", "reject"}``: typed good rows, and bad rows with their line, code and message."""
    tagged = _tagged(spark, path, schema, **options)
    good = _where(tagged, F.col("errorCode").isNull()).drop("line", "errorCode", "errorMessage")
    return {"main": _some(good, limit, sample_n, seed),
            "reject": _where(tagged, F.col("errorCode").isNotNull())}


def _some(df: DataFrame, limit: int | None, sample_n: int | None, seed: int) -> DataFrame:
    if sample_n is not None:
        df = sample_rows(df, sample_n, seed)
    return df if limit is None else df.limit(limit)


def sample_rows(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n rows in a random order fixed by the seed; each task passes on n rows at most."""
    return df.orderBy(F.xxhash64(F.lit(seed), *df.columns), *df.columns).limit(n)
