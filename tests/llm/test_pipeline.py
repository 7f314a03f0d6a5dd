import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF001
from tests.llm import cases
from vigil.llm.line_dedup import dedup_lines


def test_queries_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {n[:3].rstrip("_") for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 10)}
    assert set(entry.oracle_sql()) >= {"op5_line_dedup", "op6_secret_scan"}


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name == "line dedup":     # exactly the documents that it empties go
            had = {r.doc_id for r in docs.collect() if (r.text or "").strip()}
            left = {r.doc_id: r.text for r in dedup_lines(docs).collect()}
            emptied = {i for i in had if not left[i].strip()}
        docs = corpus_pipeline.freeze(stage(spark, docs, SF001), "test-stage")
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[1] < sizes[0] and sizes[2] == sizes[1] - len(emptied) and sizes[3] <= sizes[2]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
    assert out.count() == sizes[-1] and out.where("NOT round_trip").count() == 0


def test_stages_on_odd_and_empty_documents(spark):
    for rows in (cases.odd_texts(), []):
        docs = cases.frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.freeze(stage(spark, docs, SF001), "odd-stage")
        assert docs.count() <= len(rows)
