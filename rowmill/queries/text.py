"""Fenced blocks of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowmill.functions.fences import sql_blocks, tagged_blocks
from rowmill.functions.scalars import WHITE_SPACE
from rowmill.operators import blocks as B
from rowmill.queries import query
from rowmill.queries.fixtures import FENCED_DOCUMENTS, fenced_documents, table
from rowmill.session import scratch_path
from rowmill.sinks.files import read_blocks, write_blocks

_FENCE = "'```(?:sql)?\\n(.*?)\\n```'"
_ANY = "'(?sm)^[ ]*```(\\w*)\\n(.*?)^[ ]*```[ ]*$'"
_FOUND = f"""WITH {FENCED_DOCUMENTS}, found AS (
    SELECT doc_id, text, regexp_extract_all(text, {_FENCE}, 1, 's') AS b FROM fenced_documents),
    filled AS (SELECT doc_id, CASE WHEN len(b) = 0 THEN [text] ELSE b END AS b FROM found)"""


def _rows(source: str) -> str:
    return f"""SELECT doc_id, CAST(unnest(range(1, len(b) + 1)) AS INTEGER) AS idx, unnest(b) AS block
        FROM {source}"""


def _numbered(idx: str, block: str) -> str:
    return f"'-- model #' || {idx} || chr(10) || trim({block}, '{WHITE_SPACE}') || chr(10) || chr(10)"


_JOINED = _FOUND + f""", numbered AS ({_rows("filled")})
    SELECT doc_id, string_agg({_numbered("idx", "block")}, '' ORDER BY idx) AS text
    FROM numbered GROUP BY doc_id"""


@query("code_blocks", _FOUND + _rows("found"))
def _code_blocks(spark, d):
    return B.code_blocks(fenced_documents(spark, d), "doc_id", "text")


@query("code_blocks_or_all", _FOUND + _rows("filled"))
def _code_blocks_or_all(spark, d):
    return B.code_blocks(fenced_documents(spark, d), "doc_id", "text", fallback=True)


@query("code_blocks_tagged", f"""WITH {FENCED_DOCUMENTS}, found AS (
    SELECT doc_id, regexp_extract_all(text, {_ANY}, 1) AS langs,
           regexp_extract_all(text, {_ANY}, 2) AS b FROM fenced_documents)
    SELECT doc_id, CAST(unnest(range(1, len(b) + 1)) AS INTEGER) AS idx, unnest(langs) AS lang,
           unnest(b) AS block FROM found""")
def _code_blocks_tagged(spark, d):
    return B.code_blocks(fenced_documents(spark, d), "doc_id", "text", with_lang=True)


@query("code_blocks_per_lang", f"""WITH {FENCED_DOCUMENTS}, found AS (
    SELECT unnest(regexp_extract_all(text, {_ANY}, 1)) AS lang FROM fenced_documents)
    SELECT lang, count(*) AS n_blocks FROM found GROUP BY lang""")
def _code_blocks_per_lang(spark, d):
    found = fenced_documents(spark, d).select(F.explode(tagged_blocks(F.col("text"))).alias("b"))
    return found.groupBy("b.lang").agg(F.count(F.lit(1)).alias("n_blocks"))


@query("block_numbers", _FOUND + f""", numbered AS ({_rows("filled")})
    SELECT doc_id, idx, {_numbered("idx", "block")} AS block FROM numbered""")
def _block_numbers(spark, d):
    found = B.code_blocks(fenced_documents(spark, d), "doc_id", "text", fallback=True)
    return B.numbered_blocks(found)


@query("block_counts", _FOUND + "SELECT doc_id, CAST(len(b) AS BIGINT) AS n_blocks FROM filled")
def _block_counts(spark, d):
    found = B.code_blocks(fenced_documents(spark, d), "doc_id", "text", fallback=True)
    return B.block_counts(found, "doc_id")


@query("join_blocks", _JOINED)
def _join_blocks(spark, d):
    found = B.code_blocks(fenced_documents(spark, d), "doc_id", "text", fallback=True)
    return B.join_blocks(found, "doc_id")


@query("joined_text", _JOINED)
def _joined_text(spark, d):
    return B.joined_text(fenced_documents(spark, d), "doc_id", "text")


@query("write_blocks", _JOINED)
def _write_blocks(spark, d):
    path = scratch_path(spark, "blocks")
    write_blocks(fenced_documents(spark, d), "doc_id", "text", path)
    read = read_blocks(spark, path, "doc_id")
    return read.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.regexp_replace("value", r"\n\z", "").alias("text"))


@query("result_record", """
    SELECT doc_id, json_extract_string(r, '$.raw_output') AS raw_output,
           json_extract_string(r, '$.files.raw_txt') AS raw_txt,
           json_extract_string(r, '$.files.sql') AS sql
    FROM (SELECT doc_id, json_object('raw_output', text, 'files', json_object(
        'raw_txt', CAST(doc_id AS VARCHAR) || '.txt', 'sql', CAST(doc_id AS VARCHAR) || '.sql')) AS r
    FROM documents)""")
def _result_record(spark, d):
    name = F.col("doc_id").cast("string")
    records = B.result_record(table(spark, d, "documents"), "doc_id", "text", {
        "raw_txt": F.concat(name, F.lit(".txt")), "sql": F.concat(name, F.lit(".sql"))}, pretty=True)
    return records.select("doc_id", *[F.get_json_object("record", path).alias(c) for c, path in (
        ("raw_output", "$.raw_output"), ("raw_txt", "$.files.raw_txt"), ("sql", "$.files.sql"))])


@query("record_files", """
    SELECT doc_id, 'raw_txt' AS label, CAST(doc_id AS VARCHAR) || '.txt' AS location FROM documents
    UNION ALL SELECT doc_id, 'sql', CAST(doc_id AS VARCHAR) || '.sql' FROM documents""")
def _record_files(spark, d):
    name = F.col("doc_id").cast("string")
    records = B.result_record(table(spark, d, "documents"), "doc_id", "text", {
        "raw_txt": F.concat(name, F.lit(".txt")), "sql": F.concat(name, F.lit(".sql"))})
    return B.record_files(records, "doc_id")


@query("blocks_in_row", _FOUND + "SELECT doc_id, CAST(len(b) AS INTEGER) AS n_blocks FROM found")
def _blocks_in_row(spark, d):
    return fenced_documents(spark, d).select(
        "doc_id", F.size(sql_blocks(F.col("text"))).alias("n_blocks"))
