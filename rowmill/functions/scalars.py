"""Column expressions of the flow. Every one is a built-in JVM expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Text forms the data tests accept.
INTEGER_TEXT = r"^[-+]?[0-9]+$"
NUMERIC_TEXT = r"^-?\d+$"
STAMP_TEXT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
STAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
# The white space characters a full strip removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The eight characters in which ISO-8859-15 differs from ISO-8859-1.
LATIN1_CHARS = "¤¦¨´¸¼½¾"
LATIN9_CHARS = "€ŠšŽžŒœŸ"


def band(value: Column, low: float = 5500, high: float = 6500,
         labels: Sequence[str] = ("Low", "Medium", "High")) -> Column:
    """Low up to and including ``low``, High above ``high``, Medium between; null is Medium."""
    return (F.when(value <= F.lit(low), labels[0])
            .when(value > F.lit(high), labels[2])
            .otherwise(labels[1]))


def stamp(moment: Column | None = None, pattern: str = STAMP_PATTERN) -> Column:
    """A timestamp as text. Pass the run time to make a run repeatable."""
    return F.date_format(F.current_timestamp() if moment is None else moment, pattern)


def strip(value: Column) -> Column:
    """Remove all white space at both ends; ``trim`` alone removes spaces only."""
    return F.btrim(value, F.lit(WHITE_SPACE))


def trim_field(value: Column) -> Column:
    """Remove blanks and control characters at both ends, a stray carriage return included."""
    return F.btrim(value, F.lit("".join(map(chr, range(0x21)))))


def empty_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def or_default(value: Column, default: str) -> Column:
    """The value, or the default where it is null or empty."""
    return F.coalesce(empty_to_null(value), F.lit(default))


def cut(value: Column, length: int) -> Column:
    return F.substring(value, 1, length)


def is_integer_text(value: Column) -> Column:
    return F.regexp_like(value, F.lit(INTEGER_TEXT))


def plain_number(value: Column, thousands: str = ",", decimal: str = ".") -> Column:
    """Number text with locale separators → text that a cast understands."""
    bare = F.replace(value, F.lit(thousands), F.lit("")) if thousands else value
    return bare if decimal == "." else F.replace(bare, F.lit(decimal), F.lit("."))


def decode_number(value: Column) -> Column:
    """Hex (``0x1F``, ``#1F``) or octal (``017``) integer text → decimal text; other text unchanged."""
    sign = F.when(value.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    digits = F.regexp_replace(value, r"^[-+]", "")
    hexa = F.regexp_extract(digits, r"^(?:0[xX]|#)([0-9a-fA-F]+)$", 1)
    octal = F.regexp_extract(digits, r"^0([0-7]+)$", 1)
    return (F.when(hexa != "", F.concat(sign, F.conv(hexa, 16, 10)))
            .when(octal != "", F.concat(sign, F.conv(octal, 8, 10)))
            .otherwise(value))


def from_latin9(raw: Column) -> Column:
    """ISO-8859-15 bytes → text: read as ISO-8859-1, then swap the eight characters that differ."""
    return F.translate(F.decode(raw.cast("binary"), "ISO-8859-1"), LATIN1_CHARS, LATIN9_CHARS)


def typed(value: Column, data_type: T.DataType | str, pattern: str | None = None) -> Column:
    """Cast that gives null instead of failing; dates and timestamps may carry a pattern."""
    name = data_type if isinstance(data_type, str) else data_type.simpleString()
    if pattern and name in ("date", "timestamp", "timestamp_ntz"):
        return F.try_to_timestamp(value, F.lit(pattern)).cast(name)
    return value.try_cast(name)


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
