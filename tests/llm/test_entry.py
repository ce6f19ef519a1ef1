"""Registered queries beside their SQL, and the pipeline beside its stages."""

import importlib.util
import sys
from pathlib import Path

import pytest

from compare import connect, rows_of
from llm_fixtures import SMALL, documents, edge, none  # noqa: F401
from rowmill.llm.queries import QUERIES, SQL

ROOT = Path(__file__).resolve().parents[2]


def pipeline():
    sys.path.insert(0, str(ROOT))
    spec = importlib.util.spec_from_file_location("corpus_pipeline", ROOT / "corpus_pipeline.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SMALL)
    ours = rows_of(df.columns, df.collect())
    if name in SQL:
        result = connect(SMALL).sql(SQL[name])
        assert sorted(result.columns) == sorted(df.columns)
        assert ours == rows_of(result.columns, result.fetchall())
    else:
        assert ours


def test_a_query_per_operator_and_pipeline():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()}
    assert "pipeline" in names and set(entry.oracle_sql()) <= names


def test_pipeline(spark):
    made = pipeline()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in made.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "packing":
            assert out.schema.simpleString() == docs.schema.simpleString()
            kept = out.collect()
            assert 0 < len(kept) <= docs.count()
            docs = spark.createDataFrame(kept, docs.schema)
    want = sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in out.collect())
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in made.run(spark, SMALL).collect()) == want


def test_pipeline_on_strange_rows(spark, edge, none):
    made = pipeline()
    for docs in (edge.withColumn("n_chars", edge.n_lines), none.withColumn("n_chars", none.n_lines)):
        for name, stage in made.STAGES:
            out = stage(spark, docs, SMALL)
            if name != "packing":
                assert out.columns == docs.columns
                docs = spark.createDataFrame(out.collect(), docs.schema)
        out.collect()


def test_stages_beside_plain_python(spark):
    """Rows, texts and counts that toxicity's scores, the line rule and the item rule leave, one by one."""
    from rowmill.llm import decontam, toxicity
    made, docs = pipeline(), spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}

    def left(stage):
        return {r.doc_id: (r.text, r.n_chars) for r in stage(spark, docs, SMALL).collect()}

    scores = {r.doc_id: r.score for r in toxicity.score(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()}
    assert left(made.toxic_documents) == {i: v for i, v in rows.items() if scores[i] < 0.7}

    lower = {c: c + 32 for c in range(65, 91)}
    key = lambda line: line.strip(" \t\n\v\f\r").translate(lower)
    holders = {}
    for i, (text, _) in rows.items():
        for k in {key(line) for line in (text or "").split("\n")}:
            holders.setdefault(k, set()).add(i)
    want = {}
    for i, (text, n) in rows.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 40 or len(holders[key(x)]) < 5 or max(holders[key(x)]) == i]
        want[i] = (text, n) if len(kept) == len(lines) else ("\n".join(kept), len("\n".join(kept)))
    assert left(made.repeated_lines) == want != rows

    items = [decontam.question_and_answer(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaks = set()
    for i, (text, _) in rows.items():
        words = decontam.terms_of(text)
        held = decontam.shingles(words)
        for q, a in items:
            if decontam.contained(q + a, held, words) >= 0.8 or min(decontam.contained(p, held, words) for p in (q, a)) >= 0.8:
                leaks.add(i)
    assert left(made.benchmark_leaks) == {i: v for i, v in rows.items() if i not in leaks} != rows
