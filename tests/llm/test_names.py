"""Operators that return whole rows: helper-like, dotted, cased and map-typed columns come back as they were."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.llm import decontaminate, langid_pieces, mixing, sharding, simhash, url_filter

from .edge import documents

NAMES = ["_size", "_copies", "_copy", "_src", "_rate", "_target", "_rowkey", "rowkey_", "_bad_id", "_bad_key", "_h_id", "_h_key", "_gone", "_parted", "_own", "_ownfp", "_fp", "_row", "row", "_p", "_score", "_lang", "_hits", "hits_", "best_", "text_key", "same", "ROWKEY__", "a.b", "x y"]


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([("i", "quick brown fox jumps over the lazy dog and runs")], "item_id string, text string")


def awkward(spark, with_map=True):
    docs = documents(spark, clash=False)
    for c in NAMES:
        docs = docs.withColumn(c, F.lit(f"kept {c}"))
    return docs.withColumn("m", F.create_map(F.lit("k"), F.lit(1))) if with_map else docs


def check(out, docs, more=()):
    assert out.columns == [*docs.columns, *more]
    rows = out.collect()
    for r in rows:
        assert all(r[c] == f"kept {c}" for c in NAMES)
    have = Counter((r["doc_id"], r["lang"], r["source"]) for r in docs.collect())
    assert set(Counter((r["doc_id"], r["lang"], r["source"]) for r in rows)) <= set(have)
    return rows


@pytest.mark.parametrize("with_map", [True, False])
def test_whole_rows_come_back(spark, bench, with_map):
    docs = awkward(spark, with_map)
    n = docs.count()
    check(mixing.mix(docs), docs)
    assert len(check(decontaminate.remove_documents(docs, bench), docs)) == n - 3
    assert len(check(decontaminate.remove_spans(docs, bench), docs)) == n
    kept = check(simhash.keep_one(docs), docs)
    assert sum(r["doc_id"] == 2 for r in kept) == 0 and sum(r["doc_id"] == 1 for r in kept) == 1
    assert len(check(sharding.with_shards(docs), docs, ("shard", "slot"))) == n
    check(langid_pieces.keep_identified(docs), docs)


def test_repeated_rows_with_maps_are_one(spark):
    docs = documents(spark, [(2, "some words of a text that is here", "en", "a")] * 3, clash=False).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    assert simhash.keep_one(docs).count() == 1


def test_url_filter_replaces_its_own_names_only(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "kept", "old", "kept")], "page_id int, url string, hits_ string, host string, `a.b` string").withColumn("best_", F.lit("kept"))
    r = url_filter.judge(pages).first()
    assert r["hits_"] == r["best_"] == r["a.b"] == "kept" and r["host"] == "a.org"
