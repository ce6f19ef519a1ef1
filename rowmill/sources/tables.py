"""Named tables and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def source(spark: SparkSession, schema: str, table: str) -> DataFrame:
    return spark.table(f"{schema}.{table}")


def read_csv(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
             schema: T.StructType | str | None = None) -> DataFrame:
    """An ad-hoc CSV relation; text columns unless a schema is given."""
    reader = spark.read.option("sep", sep).option("header", header)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def seed(spark: SparkSession, path: str, name: str, schema: T.StructType | str) -> DataFrame:
    """Load a small checked-in CSV as a named table."""
    read_csv(spark, path, schema=schema).write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


def external_table(spark: SparkSession, name: str, path: str, schema: T.StructType,
                   sep: str = "|", header: bool = True) -> DataFrame:
    """A catalogue table over files that stay where they are."""
    spark.catalog.createTable(name, path=path, source="csv", schema=schema, sep=sep,
                              header=str(header).lower())
    return spark.table(name)


def read_text_lossy(spark: SparkSession, path: str) -> DataFrame:
    """``(path, text)`` per file, invalid UTF-8 replaced instead of refused."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
