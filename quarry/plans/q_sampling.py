"""Sampling queries: exact sample, split, dense shuffle ids, stratified / review
samples, proportional size adjustment, split counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import sampling as SM
from quarry.plans import sqltext as S
from quarry.plans.registry import query
from quarry.sources.tables import table

SEED = 42
VALID = 0.1


def _orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "sample_exact",
    f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY {S.hash_hex('sample', SEED, 'o_orderkey')}, o_orderkey LIMIT 1500",
)
def sample_exact(spark, d):
    """SMP1: exactly 1,500 seeded orders."""
    return SM.sample_exact(_orders(spark, d), 1500, SEED, "o_orderkey")


_SPLIT_SQL = f"""
WITH s AS (SELECT o_orderkey FROM orders),
n AS (SELECT count(*) AS n FROM s),
v AS (SELECT greatest(1, least(CAST(round_even(n * {VALID}, 0) AS BIGINT), n - 1)) AS v FROM n),
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {S.hash_hex('split', SEED, 'o_orderkey')}, o_orderkey) AS rn FROM s)
"""


def _split(spark, d):
    return SM.train_valid_split(_orders(spark, d).select("o_orderkey"), VALID, SEED, "o_orderkey")


@query(
    "train_valid_split",
    _SPLIT_SQL + "SELECT o_orderkey, CASE WHEN rn <= v THEN 'valid' ELSE 'train' END AS split FROM r, v",
)
def train_valid_split(spark, d):
    """SMP2: all orders split 90/10."""
    return _split(spark, d)


@query(
    "split_counts",
    _SPLIT_SQL
    + "SELECT (SELECT CAST(count(*) AS BIGINT) FROM orders) AS num_total_rows, CAST(count(*) AS BIGINT) AS num_sampled_rows, "
    "CAST(count_if(rn > v) AS BIGINT) AS num_train_rows, CAST(count_if(rn <= v) AS BIGINT) AS num_valid_rows FROM r, v",
)
def split_counts(spark, d):
    """AGG1: run-metadata counts (total, sampled, train, valid) in one aggregate."""
    total = table(spark, d, "orders").select(F.count(F.lit(1))).scalar()
    sp = _split(spark, d)
    return sp.agg(
        total.cast("bigint").alias("num_total_rows"),
        F.count(F.lit(1)).cast("bigint").alias("num_sampled_rows"),
        F.count_if(F.col("split") == "train").cast("bigint").alias("num_train_rows"),
        F.count_if(F.col("split") == "valid").cast("bigint").alias("num_valid_rows"),
    )


@query(
    "shuffle_with_ids",
    "SELECT o_orderkey, pos, printf('eval_%05d', pos) AS eval_id FROM (SELECT o_orderkey, "
    f"CAST(row_number() OVER (ORDER BY {S.hash_hex('shuffle', SEED, 'o_orderkey')}, o_orderkey) - 1 AS BIGINT) AS pos FROM orders)",
)
def shuffle_with_ids(spark, d):
    """SMP3 + PRJ13: seeded shuffle of all orders numbered 0..n-1 and eval_%05d ids."""
    o = table(spark, d, "orders").select("o_orderkey")
    p = SM.dense_positions(o, SEED, "o_orderkey", "pos")
    return p.select("o_orderkey", "pos", T.format_id("eval_", "pos").alias("eval_id"))


@query(
    "stratified_sample",
    "SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY "
    f"{S.hash_hex('stratified', SEED, 'doc_id')}, doc_id) AS rn FROM documents) WHERE rn <= 10",
)
def stratified_sample(spark, d):
    """SMP5: ten seeded documents per language."""
    doc = table(spark, d, "documents").select("doc_id", "lang")
    return SM.stratified_sample(doc, "lang", 10, SEED, "doc_id")


@query(
    "review_sample",
    f"SELECT doc_id, source FROM documents ORDER BY {S.hash_hex('review', SEED, 'doc_id')}, doc_id LIMIT 100",
)
def review_sample(spark, d):
    """SMP6: 100 seeded documents for manual review."""
    doc = table(spark, d, "documents").select("doc_id", "source")
    return SM.review_sample(doc, 100, SEED, "doc_id")


_SIZE_SQL = f"""
WITH c AS (SELECT source, count(*) AS n_c FROM documents GROUP BY source),
t AS (SELECT sum(n_c) AS n FROM c),
a AS (SELECT source, least(300, n) * n_c // n AS base, (least(300, n) * n_c) % n AS rem, least(300, n) AS kk FROM c, t),
b AS (SELECT source, base, kk - sum(base) OVER () AS left_, row_number() OVER (ORDER BY rem DESC, source) AS r FROM a),
q AS (SELECT source, base + CASE WHEN r <= left_ THEN 1 ELSE 0 END AS quota FROM b),
d AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {S.hash_hex('size', SEED, 'doc_id')}, doc_id) AS rn FROM documents)
SELECT d.doc_id, d.source FROM d JOIN q USING (source) WHERE rn <= quota
"""


_NULL_SRC = "(SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN source END AS source FROM documents)"


@query("size_adjust_null_stratum", _SIZE_SQL.replace("FROM documents", f"FROM {_NULL_SRC}").replace("JOIN q USING (source)", "JOIN q ON d.source IS NOT DISTINCT FROM q.source"))
def size_adjust_null_stratum(spark, d):
    """SMP7 where a quarter of the rows has no source: the null stratum gets its share."""
    doc = table(spark, d, "documents").select("doc_id", F.when(F.pmod("doc_id", F.lit(4)) != 0, F.col("source")).alias("source"))
    return SM.size_adjust(doc, 300, SEED, "source", "doc_id")


@query("size_adjust", _SIZE_SQL)
def size_adjust(spark, d):
    """SMP7: 300 documents allocated to sources by largest remainder."""
    doc = table(spark, d, "documents").select("doc_id", "source")
    return SM.size_adjust(doc, 300, SEED, "source", "doc_id")
