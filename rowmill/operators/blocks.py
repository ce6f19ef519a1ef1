"""Fenced blocks of a documents table as rows, and back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.functions.fences import (
    BLOCK_HEADER, numbered, numbered_text, or_whole, sql_blocks, tagged_blocks)

_FOUND = "__found"
_TEXT = "__text"
RECORD_SCHEMA = "raw_output STRING, files MAP<STRING, STRING>"


def code_blocks(df: DataFrame, doc: str, text: str, fallback: bool = False,
                with_lang: bool = False) -> DataFrame:
    """``(doc, idx, block)`` with ``idx`` from 1; ``with_lang`` reads every fence and its tag.

    Matched once per text: a plain explode would be given a filter that matches again.
    """
    found = _found(df, doc, text, with_lang)
    blocks = or_whole(F.col(_FOUND), F.col(_TEXT)) if fallback and not with_lang else F.col(_FOUND)
    rows = (found.select(doc, F.posexplode_outer(blocks).alias("pos", "block"))
            .filter(F.col("pos").isNotNull()))
    idx = (F.col("pos") + 1).alias("idx")
    if with_lang:
        return rows.select(doc, idx, "block.lang", "block.block")
    return rows.select(doc, idx, "block")


def _found(df: DataFrame, doc: str, text: str, with_lang: bool = False) -> DataFrame:
    """The matches in a column of their own, so that what follows shares them."""
    blocks = (tagged_blocks if with_lang else sql_blocks)(F.col(text))
    return df.select(doc, F.col(text).alias(_TEXT), blocks.alias(_FOUND))


def numbered_blocks(blocks: DataFrame, header: str = BLOCK_HEADER) -> DataFrame:
    return blocks.withColumn("block", numbered(F.col("idx"), F.col("block"), header))


def join_blocks(blocks: DataFrame, doc: str, header: str = BLOCK_HEADER) -> DataFrame:
    """The numbered blocks of each document as one text. A group is one document's own text."""
    pieces = F.sort_array(F.collect_list(F.struct("idx", "block")))
    return (blocks.groupBy(doc).agg(pieces.alias("pieces"))
            .select(doc, F.array_join(F.transform(
                "pieces", lambda p: numbered(p["idx"], p["block"], header)), "").alias("text")))


def joined_text(df: DataFrame, doc: str, text: str, header: str = BLOCK_HEADER) -> DataFrame:
    """Extract, number and join within the row: the same texts as above without a shuffle."""
    blocks = or_whole(F.col(_FOUND), F.col(_TEXT))
    return _found(df, doc, text).select(doc, numbered_text(blocks, header).alias("text"))


def block_counts(blocks: DataFrame, doc: str) -> DataFrame:
    return blocks.groupBy(doc).agg(F.count(F.lit(1)).alias("n_blocks"))


def result_record(df: DataFrame, doc: str, raw: str, files: Mapping[str, Column],
                  pretty: bool = False) -> DataFrame:
    """``(doc, record)``: the raw text and its artifacts as one JSON text."""
    pairs = [part for name, value in files.items() for part in (F.lit(name), value)]
    record = F.struct(F.col(raw).alias("raw_output"), F.create_map(*pairs).alias("files"))
    return df.select(doc, F.to_json(record, {"pretty": str(pretty).lower()}).alias("record"))


def record_files(df: DataFrame, doc: str, record: str = "record") -> DataFrame:
    """``(doc, label, location)``: the artifacts of JSON records as rows."""
    parsed = F.from_json(F.col(record), RECORD_SCHEMA)
    return (df.select(doc, F.explode_outer(F.map_entries(parsed["files"])).alias("file"))
            .filter(F.col("file").isNotNull()).select(doc, F.col("file.key").alias("label"), F.col("file.value").alias("location")))


def artifact_id(content: Column) -> Column:
    """A repeatable name for an artifact: the same text has the same one."""
    return F.sha2(content, 256)
