"""Text files of extracted blocks."""

from __future__ import annotations

import re
import shutil
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowmill.operators.blocks import joined_text

# Tasks put their own files in place; otherwise the driver renames the files of all documents, one by one. A job that fails
# may so leave some of its files, and a path is written once.
BY_TASKS = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def _on_disk(df: DataFrame, path: str) -> str | None:
    """The path as Python opens it, if it lies in a folder of this machine or one mounted alike on all."""
    default = df.sparkSession.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or ""
    if re.match(r"file:(//)?/", path):
        return re.sub(r"^file:(//)?/", "/", path)
    return path if path.startswith("/") and default.startswith("file:") else None


def _write_files(texts: DataFrame, doc: str, path: str) -> None:
    """What ``texts.write.partitionBy(doc).text(path)`` writes, file by file from the tasks.

    Hadoop's local file system starts a process for every file and folder to set its rights, which takes most of the time
    of such a write. A file is written aside and then moved to a name that a repeated attempt uses again.
    """
    if Path(path).exists():
        raise FileExistsError(f"path exists: {path}")
    Path(f"{path}/_temporary").mkdir(parents=True)

    # Nested, so that it travels to workers that do not know this package.
    def put(batches):
        import os
        import re
        import uuid
        from itertools import groupby

        from pyspark import TaskContext

        name = f"part-{TaskContext.get().partitionId():05d}.txt"
        aside = f"{path}/_temporary/{uuid.uuid4().hex}"

        def escaped(value):
            return re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value) if value else "__HIVE_DEFAULT_PARTITION__"

        key = escaped(doc)
        rows = (row for b in batches for row in zip(map(escaped, b.column(0).to_pylist()), b.column(1).to_pylist()))
        for value, lines in groupby(rows, lambda row: row[0]):
            folder = f"{path}/{key}={value}"
            with open(aside, "wb") as out:
                for _, line in lines:
                    out.write((line or b"") + b"\n")
            os.makedirs(folder, exist_ok=True)
            os.replace(aside, f"{folder}/{name}")
        yield from ()

    value = F.col(f"`{doc}`").cast("string")
    named = texts.select(F.nullif(value, F.lit("")).alias("doc"), F.col("value").cast("binary").alias("value"))
    named.sortWithinPartitions("doc").mapInArrow(put, "doc string").write.format("noop").mode("overwrite").save()
    shutil.rmtree(f"{path}/_temporary", ignore_errors=True)
    Path(f"{path}/_SUCCESS").touch()


def write_blocks(df: DataFrame, doc: str, text: str, path: str, per_document: bool = True) -> None:
    """The numbered blocks of each document, in order, as text.

    One folder and file per document, or, for a large corpus, one line group per document in
    shared files. On a local or mounted file system the tasks put the files of documents there themselves.
    """
    texts = joined_text(df, doc, text).withColumnRenamed("text", "value")
    here = _on_disk(df, path) if per_document else None
    if here:
        _write_files(texts, doc, here)
    elif per_document:
        texts.write.options(**BY_TASKS).partitionBy(doc).text(path)
    else:
        texts.select("value").write.text(path)


def read_blocks(spark: SparkSession, path: str, doc: str) -> DataFrame:
    """``(doc, value)`` of the files that ``write_blocks`` put there, a row a file; ``doc`` is text.

    The document is told from the path of its file where that is read: partition discovery would compare the folders of all
    documents on the driver.
    """
    def decoded(name):
        return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))

    # The folder's name is escaped by the writer and, as part of an address, once more.
    name = decoded(decoded(F.regexp_extract(F.col("_metadata.file_path"), "=([^/]*)/[^/]*$", 1)))
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return files.select(F.nullif(name, F.lit("__HIVE_DEFAULT_PARTITION__")).alias(doc), "value")
