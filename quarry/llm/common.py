"""Helpers shared by the training-data operators."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.sources.scratch import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that to pure ASCII text, and far
    faster than a character map, so only other texts take the map."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(c, UPPER, LOWER)).otherwise(F.lower(c))


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage at files every executor can reach. The files go when the
    driver's file system is closed at the end of the application."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_rows(docs: DataFrame, **derived: Column) -> DataFrame:
    """The ``derived`` columns and each row of ``docs`` as one struct ``row``, so that no name of it can clash."""
    return docs.select(*[c.alias(n) for n, c in derived.items()], F.struct(*[quoted(c) for c in docs.columns]).alias("row"))


def fields_of(docs: DataFrame, **replaced: Column) -> list[Column]:
    """The columns of ``docs`` out of its struct ``row``, in order, some of them replaced."""
    return [replaced.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``docs`` has it in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def salt_of(*cols, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


def running_total(df: DataFrame, part: list[str], order: list, value: Column, out: str) -> DataFrame:
    """Exclusive running total of ``value`` in each ``part``, without one task per part.

    ``df`` must carry an int column ``_bucket`` (hundreds to thousands of values),
    a function of the row: rows are ordered by bucket, then by ``order`` inside the bucket.
    Each (part, bucket) is one window group; the bucket totals
    (parts x buckets rows at most) give the offsets. The rows already lie by those keys,
    so only the offsets move to meet them. ``part`` columns must not be null."""
    v = df.withColumn("_v", value.cast("bigint"))
    keys = [*part, "_bucket"]
    totals = v.groupBy(*keys).agg(F.sum("_v").alias("_t"))
    before = Window.partitionBy(*part).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = v.withColumn("_in", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    return ranked.join(offsets, keys).withColumn(out, F.col("_off") + F.col("_in")).drop("_v", "_in", "_off")


def salts_for(rows: int, least: int = 16) -> int:
    """Salts for a key that may hold any share of ``rows``: about as many as rows stay in each."""
    return max(least, isqrt(rows))


def with_least(rows: DataFrame, key: str, value: str, out: str, salt: str, salts: int) -> DataFrame:
    """``rows`` with the smallest ``value`` of their ``key`` as ``out``.

    Minima are taken per (key, salt), then per key, and return the same way: of a
    hot key at most ``salts`` rows meet in a task. ``key`` must not be null."""
    dealt = rows.withColumn("_s", salt_of(salt, buckets=salts))
    parts = dealt.groupBy(key, "_s").agg(F.min(value).alias(out))
    back = parts.select(key, "_s").join(parts.groupBy(key).agg(F.min(out).alias(out)), key)
    return dealt.join(back, [key, "_s"]).drop("_s")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) with root the smallest node reachable, for undirected edges (a, b).

    Alternating large-star / small-star steps (Kiveris et al. 2014): every step
    is one minimum per node, handed back to its edges by salted keys, so
    a hot centre is never gathered. Each round is written to the shared folder;
    the rounds end when the edges no longer change."""
    cur = stored(edges.where(F.col("a") != F.col("b")).distinct(), "cc")
    last = None
    while True:
        state = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == last:
            break
        last = tuple(state)
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(cur.select(F.col("b").alias("u"), F.col("a").alias("v")))
        salts = salts_for(2 * state[0])
        large = with_least(both, "u", "v", "m", "v", salts).where("v > u").select(F.col("v").alias("a"), F.least("m", "u").alias("b")).where("a != b")
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
        starred = with_least(down, "u", "v", "m", "v", salts)
        # an edge to the minimum itself stands for the node: (v, m) is empty there
        small = starred.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("a"), F.col("m").alias("b"))
        cur = stored(small.where("a != b").distinct(), "cc")
    leaves = cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
