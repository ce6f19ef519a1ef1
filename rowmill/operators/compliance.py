"""Check rows against a schema and split them into pass and reject.

Codes per column: 2 wrong type or date pattern, 4 empty or null, 8 too long or too precise. A row
with one bad column carries the sum of that column's codes; a row with more carries 16.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowmill.functions.scalars import cut, empty_to_null, typed

# The error codes.
TYPE_CODE = 2
EMPTY_CODE = 4
LENGTH_CODE = 8
MANY_CODE = 16

DATE_TYPES = ("date", "timestamp", "timestamp_ntz")


@dataclass(frozen=True)
class ColumnRule:
    """What one column must satisfy; ``max_length`` and ``precision`` None mean no limit."""

    name: str
    type: str = "string"
    nullable: bool = True
    max_length: int | None = None
    precision: int | None = None
    pattern: str | None = None


def rules_from_schema(schema: T.StructType) -> list[ColumnRule]:
    """One rule per declared column; length, precision and pattern come from field metadata."""
    def limit(field: T.StructField, name: str) -> int | None:
        value = (field.metadata or {}).get(name)
        return None if value is None or value < 0 else value

    return [ColumnRule(f.name, f.dataType.simpleString(), f.nullable, limit(f, "length"),
                       limit(f, "precision"), (f.metadata or {}).get("pattern") or None)
            for f in schema.fields]


def positional_rules(df: DataFrame, schema: T.StructType) -> list[ColumnRule]:
    """Rules of another schema, its n-th column applied to the n-th input column; as many of each."""
    return [replace(rule, name=name) for rule, name in zip(rules_from_schema(schema), df.columns, strict=True)]


def _matches_date(value: Column, rule: ColumnRule, mode: str, ignore_zone: bool) -> Column:
    if ignore_zone:
        value = F.regexp_replace(value, r"\s*(Z|[-+]\d{2}:?\d{2})$", "")
    if mode == "fast":
        shape = re.sub(r"[A-Za-z]", r"\\d", re.sub(r"([^A-Za-z])", lambda m: re.escape(m[1]),
                                                   rule.pattern))
        return F.regexp_like(value, F.lit(f"^{shape}$"))
    if mode == "lenient":
        loose = re.sub(r"([MdHms])\1", r"\1", rule.pattern)
        return F.try_to_timestamp(value, F.lit(loose)).isNotNull()
    return F.try_to_timestamp(value, F.lit(rule.pattern)).isNotNull()


def _column_code(df: DataFrame, rule: ColumnRule, empty_is_null: bool, date_mode: str,
                 ignore_zone: bool) -> Column:
    column = F.col(f"`{rule.name}`")
    held = df.schema[rule.name].dataType
    value = empty_to_null(column) if empty_is_null and isinstance(held, T.StringType) else column
    text = value.cast("string")

    if rule.pattern and rule.type in (*DATE_TYPES, "string"):
        right_type = _matches_date(text, rule, date_mode, ignore_zone)
    elif held.simpleString() == rule.type or rule.type == "string":
        right_type = F.lit(True)
    else:
        right_type = typed(value, rule.type).isNotNull()
    code = F.when(~right_type, TYPE_CODE).otherwise(0)

    over = []
    if rule.max_length is not None:
        over.append(F.length(text) > rule.max_length)
    if rule.precision is not None and rule.type != "string":
        if isinstance(held, (T.FloatType, T.DoubleType)):  # their text may have an exponent
            over.append(value != F.round(value, rule.precision))
        else:
            digits = F.regexp_extract(text, r"^[-+]?\d*\.(\d*?)0*$", 1)
            over.append(F.length(digits) > rule.precision)
    if over:
        code = code + F.when(reduce(lambda a, b: a | b, over), LENGTH_CODE).otherwise(0)
    return F.when(value.isNull(), F.lit(0 if rule.nullable else EMPTY_CODE)).otherwise(code)


def _reason(code: Column, name: str) -> Column:
    words = [F.when(code.bitwiseAND(TYPE_CODE) != 0, "type"),
             F.when(code.bitwiseAND(EMPTY_CODE) != 0, "empty"),
             F.when(code.bitwiseAND(LENGTH_CODE) != 0, "length")]
    return F.when(code != 0, F.concat(F.lit(f"{name}:"), F.concat_ws("+", *words)))


def _coded(df: DataFrame, rules: Sequence[ColumnRule], empty_is_null: bool | Sequence[str] = True,
           substring: bool = False, date_mode: str = "strict", ignore_timezone: bool = False
           ) -> tuple[DataFrame, dict[str, str]]:
    """The rows with one integer code column per rule, and those columns by rule name, sorted."""
    if date_mode not in ("strict", "lenient", "fast"):
        raise ValueError(f"unknown date_mode: {date_mode}")
    if substring:
        texts = {r.name: cut(F.col(f"`{r.name}`"), r.max_length) for r in rules
                 if r.max_length is not None
                 and isinstance(df.schema[r.name].dataType, T.StringType)}
        df = df.withColumns(texts) if texts else df
    by_name = {r.name: r for r in rules}
    places = {name: f"__code_{i}" for i, name in enumerate(sorted(by_name))}

    def empties(name: str) -> bool:
        return empty_is_null if isinstance(empty_is_null, bool) else name in empty_is_null

    return df.withColumns({place: _column_code(df, by_name[name], empties(name), date_mode,
                                               ignore_timezone)
                           for name, place in places.items()}), places


def _tagged(coded: DataFrame, places: dict[str, str]) -> DataFrame:
    marks = [F.col(place) for place in places.values()]
    bad = reduce(lambda a, b: a + b, [F.when(m != 0, 1).otherwise(0) for m in marks], F.lit(0))
    total = reduce(lambda a, b: a + b, marks, F.lit(0))
    code = F.when(bad == 1, total.cast("string")).when(bad > 1, F.lit(str(MANY_CODE)))
    reasons = [_reason(F.col(place), name) for name, place in places.items()]
    message = F.nullif(F.concat_ws(";", *reasons), F.lit(""))
    return coded.withColumns({"errorCode": code, "errorMessage": message}).drop(*places.values())


def tag_compliance(df: DataFrame, rules: Sequence[ColumnRule], **options) -> DataFrame:
    """Every row with ``errorCode`` and ``errorMessage``, both null where the row is right.

    ``empty_is_null`` (all text columns, none, or a list) counts empty text as null. ``substring``
    shortens text over its limit instead of rejecting the row. ``date_mode`` is strict (exact
    pattern), lenient (unpadded parts allowed) or fast (digits in place only).
    """
    return _tagged(*_coded(df, rules, **options))


def compliance(df: DataFrame, rules: Sequence[ColumnRule], **options) -> dict[str, DataFrame]:
    """``{"pass", "reject"}`` without a shuffle; see ``tag_compliance`` for the options.

    The parts are cut by the plain code columns: Spark copies what a filter tests into the filter,
    and the codes are short where ``errorCode`` is long.
    """
    coded, places = _coded(df, rules, **options)
    right = reduce(lambda a, b: a & b, [F.col(p) == 0 for p in places.values()], F.lit(True))
    return {"pass": coded.filter(right).drop(*places.values()),
            "reject": _tagged(coded.filter(~right), places)}
