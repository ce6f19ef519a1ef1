"""Other columns, whatever their names, come back as they were; an index before its first document, and its appends."""

import glob

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SMALL, LINE  # noqa: F401
from rowmill.llm import decontam, line_dedup, line_rules, manifest, packing, pseudonyms, quality, simhash, suffix_dedup, tokens, toxicity
from rowmill.llm.line_dedup import LineIndex
from test_entry import pipeline

ODD = ["__id", "__hash", "__doc", "__keys", "__new", "__values", "__words", "__lines", "__text", "__spoken", "__good", "__c3", "a.b", "a`b", "hash", "row",
       "label", "TEXT", "doc", "key", "é ß"]


@pytest.fixture(scope="module")
def odd(spark):
    """Documents between columns of awkward names, whose values say where they belong."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).select("doc_id", "text", "lang", "source", "n_chars")
    extra = [F.concat(F.lit(f"{i}:"), F.col("doc_id").cast("string")) for i in range(len(ODD))]
    wide = docs.select(*extra[:10], "doc_id", *extra[10:], "text", "lang", "source", "n_chars")
    named = wide.toDF(*ODD[:10], "doc_id", *ODD[10:], "text", "lang", "source", "n_chars")
    return spark.createDataFrame(named.collect(), named.schema)


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


OPERATORS = {
    "pseudonyms": lambda df, s: pseudonyms.pseudonymize(df, key="k"),
    "lines": lambda df, s: line_dedup.dedup_lines(df),
    "rules": lambda df, s: line_rules.clean_lines(df),
    "simhash": lambda df, s: simhash.keep_one(df),
    "toxicity": lambda df, s: toxicity.keep_clean(df, table(s, "labels")),
    "decontamination": lambda df, s: decontam.decontaminate(df, table(s, "benchmark"), whole=True),
    "manifest": lambda df, s: manifest.manifest(df),
    "quality": lambda df, s: quality.score(df, table(s, "labels")),
    "suffixes": lambda df, s: suffix_dedup.remove_repeats(df),
    "fingerprints": lambda df, s: simhash.near_duplicates(df),
    "packing": lambda df, s: packing.pack(df, public_tokenizers.path("byte_bpe_50k.json")),
    "tokens": lambda df, s: tokens.count_tokens(df, public_tokenizers.path("word_bpe_49k.json")),
}


def values(df):
    """Rows by doc_id of the columns that no operator reads, by place, as names with signs are hard to ask for."""
    plain = df.toDF(*[f"x{i}" for i in range(len(df.columns))])
    own = df.columns.index("doc_id")
    return {r[own]: {n: v for n, v in zip(df.columns, r) if n in ODD} for r in plain.collect()}


READ_ONLY = {"manifest", "quality", "suffixes", "fingerprints", "packing"}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_other_columns_come_back(spark, odd, name):
    out, want = OPERATORS[name](odd, spark), values(odd)
    if name in READ_ONLY:
        plain = OPERATORS[name](odd.toDF(*[c if c in ("doc_id", "text", "lang", "source", "n_chars") else f"x{i}" for i, c in enumerate(odd.columns)]), spark)
        assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
        return
    assert [c for c in out.columns if c in odd.columns] == [c for c in odd.columns if c in out.columns]
    assert set(ODD) <= set(out.columns)
    got = values(out)
    assert got and all(want[i] == held for i, held in got.items())


def test_pipeline_stages_return_the_columns_of_documents(spark, odd):
    want, docs = values(odd), odd
    for name, stage in pipeline().STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.schema.simpleString() == odd.schema.simpleString()
        rows = out.collect()
        docs = spark.createDataFrame(rows, odd.schema)
        got = values(docs)
        assert got and all(want[i] == held for i, held in got.items())
    assert packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).count() >= len(got)


def test_columns_that_are_added_replace_their_namesakes(spark):
    df = spark.createDataFrame([(1, "a b", "old", "old")], "doc_id long, text string, n_lines string, n_tokens string")
    assert line_dedup.dedup_lines(df).select("n_lines", "n_tokens").collect() == [(1, "old")]
    counted = tokens.count_tokens(df, public_tokenizers.path("word_bpe_49k.json"))
    assert counted.select("n_tokens", "n_lines").collect() == [(2, "old")]


def test_an_index_without_documents_drops_nothing(spark):
    df = spark.createDataFrame([(1, LINE), (2, LINE), (None, None)], "doc_id long, text string")
    index = LineIndex(spark, min_docs=2)
    assert sorted(r.n_dropped for r in index.clean(df).collect()) == [0, 0, 0]
    index = LineIndex(spark, min_docs=2).delete(df.select("doc_id"))
    assert sorted(r.n_dropped for r in index.clean(df, indexed=True).collect()) == [0, 0, 0]
    assert sorted(r.n_dropped for r in index.insert(df).clean(df).collect()) == [0, 0, 1]


def rows_written(label, since):
    from pyspark.sql import SparkSession
    from rowmill.session import shared_folder
    spark = SparkSession.getActiveSession()
    paths = [p for p in glob.glob(f"{shared_folder(spark)}/rowmill/{label}-*") if p not in since]
    return sum(spark.read.parquet(p).count() for p in paths), paths


def test_changes_write_only_what_changes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("rowmill.session.shared_folder", lambda s: str(tmp_path))
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit(f"{LINE} "), F.col("id") % 50, F.lit("\n"), F.lit(f"{LINE} alone "), "id").alias("text"))
    part = docs.filter("doc_id % 100 = 7")
    index = LineIndex(spark, min_docs=2).insert(docs.filter("doc_id % 100 <> 7"))
    seen = glob.glob(f"{tmp_path}/rowmill/*")
    index.insert(part)
    assert rows_written("line-references", seen)[0] == 2 * part.count()
    seen = glob.glob(f"{tmp_path}/rowmill/*")
    index.delete(part.select("doc_id"))
    assert rows_written("line-references", seen)[0] == 0 and rows_written("line-deletions", seen)[0] == part.count()
    fresh = LineIndex(spark, min_docs=2).insert(docs.filter("doc_id % 100 <> 7"))
    assert sorted(map(tuple, index.common.collect())) == sorted(map(tuple, fresh.common.collect()))


def test_many_changes(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit(f"{LINE} "), F.col("id") % 4).alias("text"))
    index = LineIndex(spark, min_docs=2)
    for i in range(line_dedup.MOST_CHANGES + 2):
        index.insert(docs.filter(F.col("doc_id") % 20 == i))
    index.delete(docs.filter("doc_id = 0").select("doc_id")).insert(docs.filter("doc_id = 1"))
    left = docs.filter(f"doc_id % 20 < {line_dedup.MOST_CHANGES + 2} AND doc_id <> 0")
    assert sorted(map(tuple, index.common.collect())) == sorted(map(tuple, LineIndex(spark, min_docs=2).insert(left).common.collect()))
