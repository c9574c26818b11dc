import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import mixing as M

from .edge import documents, rows_of


def brute_targets(sizes):
    """Stop at three times the size, share the excess by weight, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, stopped, left = {}, set(), sum(sizes.values())
    while True:
        rest = [s for s in order if s not in stopped]
        if not rest:
            return target
        share = left / sum(weight[s] for s in rest)
        over = [s for s in rest if share * weight[s] > 3 * sizes[s]]
        if not over:
            target |= {s: share * weight[s] for s in rest}
            return target
        for s in over:
            target[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
            stopped.add(s)


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 2, None: 50}, {"a": 5}, {"a": 0, "b": 0}, {"a": 0, "b": 9}, {chr(97 + i): 3**i for i in range(12)}, {"b": 1000, "B": 10, "é": 10, "z": 10}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    got = {r["source"]: (r["source_size"], r["target"]) for r in M.source_rates(df).collect()}
    want = brute_targets(sizes)
    assert {s: n for s, (n, _) in got.items()} == sizes
    for s in sizes:
        assert got[s][1] == pytest.approx(want[s], rel=1e-12, abs=1e-9)


def test_edges(spark):
    docs = documents(spark)
    m = rows_of(M.with_copies(docs))
    assert len(m) == docs.count()
    for r in m:
        assert r["_size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        assert 0 <= r["_copies"] <= 3
    two = [r["_copies"] for r in m if r["doc_id"] == 2]
    assert len(two) == 2 and two[0] == two[1]
    out = M.mix(docs)
    assert out.columns == docs.columns and out.count() == sum(r["_copies"] for r in m)
    assert M.mix(docs.limit(0)).count() == 0


def test_totals_come_near_targets_and_reruns_agree(spark):
    base = spark.range(30000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w "), F.repeat(F.lit("x "), (F.col("id") % 50).cast("int"))).alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 4).cast("string"))).alias("source"))
    m = M.with_copies(base).withColumn("taken", F.col("_size") * F.col("_copies"))
    per = rows_of(m.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("_target").alias("target")))
    for r in per:
        assert r["taken"] == pytest.approx(r["target"], rel=0.06)
    again = M.with_copies(base.repartition(7)).agg(F.sum(F.col("_copies") * F.hash("doc_id"))).first()[0]
    assert again == m.agg(F.sum(F.col("_copies") * F.hash("doc_id"))).first()[0]


def test_many_sources_join_by_shuffle(spark):
    docs = documents(spark)
    a = sorted((r["doc_id"] or 0, r["_copies"]) for r in rows_of(M.with_copies(docs, broadcast_sources=0)))
    assert a == sorted((r["doc_id"] or 0, r["_copies"]) for r in rows_of(M.with_copies(docs)))
