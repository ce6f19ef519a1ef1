"""Fenced code blocks inside text, one document per row, without leaving the row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rowmill.functions.scalars import strip

# The two fence patterns. The first takes the next fence it meets as an opening one,
# so a block with another tag shifts all that follow; the second is anchored to whole lines.
SQL_FENCE = r"(?s)```(?:sql)?\n(.*?)\n```"
ANY_FENCE = r"(?sm)^[ ]*```(\w*)\n(.*?)^[ ]*```[ ]*$"
BLOCK_HEADER = "-- model #"


def sql_blocks(text: Column) -> Column:
    """Bodies of untagged or ``sql`` fences."""
    return F.regexp_extract_all(text, F.lit(SQL_FENCE), F.lit(1))


def or_whole(blocks: Column, text: Column) -> Column:
    """The blocks, or where there is none the whole text as the one block."""
    return F.when(F.size(blocks) == 0, F.array(text)).otherwise(blocks)


def tagged_blocks(text: Column) -> Column:
    """``(lang, block)`` of every fence, whatever its tag or indent.

    The text is matched once; a fence then comes apart at its first and its last line.
    """
    def apart(fence: Column) -> Column:
        rest = F.substr(fence, F.instr(fence, "\n") + 1)
        return F.struct(F.regexp_extract(fence, r"^[ ]*```(\w*)", 1).alias("lang"),
                        F.left(rest, F.length(rest) - F.length(F.substring_index(rest, "\n", -1))).alias("block"))

    return F.transform(F.regexp_extract_all(text, F.lit(ANY_FENCE), F.lit(0)), apart)


def numbered(idx: Column, block: Column, header: str = BLOCK_HEADER) -> Column:
    """One block under a numbered header line, stripped, followed by a blank line."""
    return F.concat(F.lit(header), idx.cast("string"), F.lit("\n"), strip(block), F.lit("\n\n"))


def numbered_text(blocks: Column, header: str = BLOCK_HEADER) -> Column:
    """All blocks of one document as one text, numbered from 1 in order."""
    return F.array_join(F.transform(blocks, lambda b, i: numbered(i + 1, b, header)), "")
