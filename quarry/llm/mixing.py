"""Mixing sources to target weights: repetition rates, then copies drawn by hash.

DataFrame functions only. Sizes (words) are summed per source with map-side
combining; the rates come from that table of one row per source; each document
is then written ``floor(rate)`` times plus one copy more when a hash of its id
falls below the rate's fraction. No document is shuffled: the rates are
broadcast while there are at most ``broadcast_sources`` sources, else joined
by shuffle, where AQE splits a hot source.

Null text has size 0. A null source is a source of its own, sorted last. A
source of size 0 gets target 0. Repeated rows (same id) get the same draw. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import hex8_to_long, seeded_hash
from quarry.llm.common import fields_of, quoted, read, whole_rows
from quarry.llm.registry import query

WORD = r"[^\x20\x09-\x0D]+"
SEED = 17
MAX_REPEAT = 3


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_rates(sizes: DataFrame, weights: list[float] = (1, 2, 3), max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target, rate) from (source, size) rows.

    Sources take the weights in code-point order, null last, over and over, and
    share the total size by weight; a target stops at ``max_repeat`` times its
    source and the excess is shared by weight among the rest. With the sources
    in order of cap / weight the stopped ones come first, so running totals over
    the source table find the level that the others reach, in one pass."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ws = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.get(ws, ((F.row_number().over(order) - 1) % len(weights)).cast("int")))
    per = per.withColumn("cap", (F.col("source_size") * max_repeat).cast("double"))
    by = [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()]
    done = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*by).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(every).cast("double") - F.coalesce(F.sum("cap").over(done), F.lit(0.0))) / F.sum("weight").over(rest)
    per = per.withColumn("level", level).withColumn("pos", F.row_number().over(Window.orderBy(*by)))
    open_level = F.min_by(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("level")), F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("pos"))).over(every)
    target = F.coalesce(F.least(F.col("cap"), open_level * F.col("weight")), F.col("cap"))
    per = per.withColumn("target", target)
    return per.select("source", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"))


def copies_of(doc_id: Column, rate: Column, seed: int = SEED) -> Column:
    u = hex8_to_long(seeded_hash("mix", seed, F.coalesce(doc_id.cast("string"), F.lit("")))) / F.lit(float(1 << 32))
    whole = F.floor(rate)
    return whole + F.when(u < rate - whole, 1).otherwise(0)


def with_copies(docs: DataFrame, weights=(1, 2, 3), seed: int = SEED, broadcast_sources: int = 100_000) -> DataFrame:
    """``docs`` with _size, _source_size, _target and _copies added."""
    sized = docs.withColumn("_size", size_of(F.col("text")))
    rates = source_rates(sized.select("source", F.col("_size").alias("size")), weights)
    rates = rates.select(F.col("source").alias("_src"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), F.col("rate").alias("_rate"))
    n = docs.agg(F.approx_count_distinct("source")).first()[0]
    rates = F.broadcast(rates) if n <= broadcast_sources else rates
    j = sized.join(rates, F.col("source").eqNullSafe(F.col("_src")))
    return j.withColumn("_copies", copies_of(F.col("doc_id"), F.col("_rate"), seed)).drop("_src", "_rate")


def mix(docs: DataFrame, weights=(1, 2, 3), seed: int = SEED) -> DataFrame:
    """The mixed documents: every column of ``docs``, each row as often as the mix takes it."""
    rows = whole_rows(docs, doc_id=quoted("doc_id"), source=quoted("source"), text=quoted("text"))
    m = with_copies(rows, weights, seed).where("_copies > 0")
    return m.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*fields_of(docs))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight, (source_size * 3)::DOUBLE AS cap FROM s),
l AS (SELECT *, row_number() OVER o AS pos,
        ((SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
t AS (SELECT source, source_size, coalesce(least(cap, (SELECT arg_min(level, pos) FROM l WHERE cap >= level * weight) * weight), cap) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
u AS (SELECT d.*, r.source_size, r.target, r.rate, ('0x' || md5('mix|17|' || coalesce(d.doc_id::VARCHAR, ''))[1:8])::BIGINT / 4294967296.0::DOUBLE AS u
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM u
"""


@query("op3_mixing", OP3_SQL)
def op3_mixing(spark, d):
    """The words each document adds to the mix."""
    m = with_copies(read(spark, d, "documents").select("doc_id", "source", "text"))
    return m.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).cast("bigint").alias("taken"))
