"""Streaming smoke test and physical-plan checks."""

import json

import __spark_entry__ as E
from quarry.operators import sampling
from quarry.plans.catalog import load_all
from quarry.sources.tables import table
from quarry.streaming import curate_stream


def test_curate_stream_matches_batch(spark, sf):
    docs = table(spark, sf, "documents")
    stream = spark.readStream.schema(docs.schema).option("pathGlobFilter", "documents.parquet").parquet(sf)
    q = curate_stream(stream).writeStream.format("memory").queryName("curated_docs").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = sorted(r["doc_id"] for r in spark.sql("SELECT doc_id FROM curated_docs").collect())
    want = sorted(r["doc_id"] for r in curate_stream(docs).select("doc_id").collect())
    assert got == want and len(got) > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_cartesian_product_and_python_only_where_expected(spark, sf):
    qs = load_all()[0]
    python_ok = {"canonical_answer", "normalize_answer", "prediction_table", "exact_match_accuracy", "reward_table", "error_classes", "prediction_csv"}
    # steps without a built-in form: packed language scores, piece lattices, exact rationals, the search of bit rules, windows at every word
    python_ok |= {"ngram_repetition_sliding", "language_id", "language_filter", "truncate_to_pieces", "exact_answer_value", "majority_vote_by_value", "self_consistency_by_value", "verify_consistency"}
    skip = {"token_count_by_vocab", "csv_roundtrip", "corpus_lines", "prediction_csv"}
    for name, fn in qs.items():
        if name in skip:
            continue
        plan = _plan(fn(spark, sf))
        assert "CartesianProduct" not in plan, name
        if name not in python_ok:
            assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan, name


def test_stratified_sample_ranks_boundary_rows_only(spark, sf):
    """No window over whole categories, whatever k: rows are ranked behind a join with each category's boundary prefix."""
    for k in (10, 5000):
        plan = _plan(sampling.stratified_sample(table(spark, sf, "documents").select("doc_id", "lang"), "lang", k, 1, "doc_id"))
        assert "WindowGroupLimit" not in plan and "_bp#" in plan


def test_scan_prunes_columns(spark, sf):
    plan = _plan(E.queries()["token_length_filter"](spark, sf))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "mean" in df.columns
