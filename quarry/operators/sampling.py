"""Exact, reproducible sampling, splitting and ranking without a global sort.

Every row gets ``h = md5('tag|seed|id')``. "The k rows with the smallest
(h, id)" is an exact, partition-independent sample. It is found without
sorting the table:

1. count rows per hash prefix (at most 16^P groups per stratum; P=4 -> 65,536),
2. a running count over that small table finds the boundary prefix,
3. only the rows of the boundary prefix are ranked to get the k-th key,
4. one filter pass ``(h, id) <= k-th key`` selects the sample.

Dense positions (a shuffled ``0..n-1`` numbering) use per-prefix offsets and a
``row_number`` partitioned by prefix; md5 prefixes are uniform, so no task
gets more than ~n/16^P rows. Rows that share an id share (h, id); where the
k-th key is such a tie, only as many of its rows are taken as are still needed,
so the sample has exactly k rows. A null stratum is a stratum like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import seeded_hash

PREFIX_HEX = 4
# Broadcast only tables whose size is bounded by construction (prefix
# histograms, per-group quotas); this cap (a few MB of keys) guards the
# per-group variants, beyond it the key table is joined by a shuffle.
MAX_BROADCAST_ROWS = 200_000


def with_hash(df: DataFrame, id_col: str, seed: int, tag: str, out: str = "_h") -> DataFrame:
    return df.withColumn(out, seeded_hash(tag, seed, id_col))


def _key_le(h: Column, i: Column, kh: Column, ki: Column) -> Column:
    return (h < kh) | ((h == kh) & (i <= ki))


def _on_group(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on the stratum columns, null matching null; ``left``'s columns and the rest of ``right``'s."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in cols else F.col(c) for c in right.columns])
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(r[f"_r_{c}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in cols])


def kth_keys(
    df: DataFrame, quota: int | DataFrame, h: str = "_h", id_col: str = "id", group: Sequence[str] = (), prefix_hex: int = PREFIX_HEX
) -> tuple[DataFrame, bool]:
    """Per stratum (``group``; one stratum when empty) the quota and the k-th
    smallest (h, id): columns group..., quota, kh, kid, kn. kh/kid are null when
    the quota covers the whole stratum; kn is how many rows with that very key
    are among the first k (1 where ids are unique). Returns (keys, small): ``small`` says
    the key table was proven small enough to broadcast (one row per stratum)."""
    group = list(group)
    g_cols = group or ["_g"]
    src = df if group else df.withColumn("_g", F.lit(0))
    pre = F.substring(F.col(h), 1, prefix_hex)
    hist = src.groupBy(*g_cols, pre.alias("_pre")).agg(F.count(F.lit(1)).alias("_c"))
    if isinstance(quota, int) and not group:
        q = df.sparkSession.range(1).select(F.lit(0).alias("_g"), F.lit(quota).cast("bigint").alias("quota"))
        small = True
    else:
        if isinstance(quota, int):
            q = hist.select(*g_cols).distinct().withColumn("quota", F.lit(quota).cast("bigint"))
        else:
            q = quota if group else quota.withColumn("_g", F.lit(0))
            q = q.select(*g_cols, F.col("quota").cast("bigint"))
        small = q.count() <= MAX_BROADCAST_ROWS
    w = Window.partitionBy(*g_cols).orderBy("_pre").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    qb = F.broadcast(q) if small else q
    cum = _on_group(hist.withColumn("_cum", F.sum("_c").over(w)), qb, g_cols)
    boundary = (
        cum.where((F.col("_cum") >= F.col("quota")) & (F.col("quota") > 0))
        .groupBy(*g_cols)
        .agg(F.min_by(F.struct(F.col("_pre"), (F.col("quota") - F.col("_cum") + F.col("_c")).alias("need")), F.col("_pre")).alias("b"))
        .select(*g_cols, F.col("b._pre").alias("_bp"), F.col("b.need").alias("_need"))
    )
    cand = _on_group(src, F.broadcast(boundary) if small else boundary, g_cols).where(pre == F.col("_bp"))
    rw = Window.partitionBy(*g_cols).orderBy(F.col(h), F.col(id_col))
    kth = (
        cand.withColumn("_rn", F.row_number().over(rw))
        .withColumn("_first", F.min("_rn").over(Window.partitionBy(*g_cols, F.col(h), F.col(id_col))))
        .where(F.col("_rn") == F.col("_need"))
        .select(*g_cols, F.col(h).alias("kh"), F.col(id_col).alias("kid"), (F.col("_need") - F.col("_first") + 1).alias("kn"))
    )
    return _on_group(q, kth, g_cols, "left"), small


def select_k_smallest(
    df: DataFrame, quota: int | DataFrame, h: str = "_h", id_col: str = "id", group: Sequence[str] = (), flag: str | None = None
) -> DataFrame:
    """Rows with the ``quota`` smallest (h, id) per stratum. With ``flag`` set,
    every row is kept and ``flag`` tells whether it is selected."""
    group = list(group)
    g_cols = group or ["_g"]
    src = df if group else df.withColumn("_g", F.lit(0))
    keys, small = kth_keys(df, quota, h, id_col, group)
    j = _on_group(src, F.broadcast(keys) if small else keys, g_cols, "left")
    at_key = F.coalesce((F.col(h) == F.col("kh")) & F.col(id_col).eqNullSafe(F.col("kid")), F.lit(False))
    sel = (
        F.when(F.col("quota").isNull() | (F.col("quota") <= 0), F.lit(False))
        .when(F.col("kh").isNull(), F.lit(True))
        .otherwise(_key_le(F.col(h), F.col(id_col), F.col("kh"), F.col("kid")))
    )
    out_cols = list(df.columns)
    # the k-th key's own rows (one per stratum where ids are unique) are counted off
    tie = Window.partitionBy(*g_cols).orderBy(F.col(h))
    ends = j.where(at_key).withColumn("_take", F.row_number().over(tie) <= F.col("kn"))
    rest = j.where(~at_key).withColumn("_take", F.coalesce(sel, F.lit(False)))
    both = rest.unionByName(ends)
    if flag:
        return both.select(*out_cols, F.col("_take").alias(flag))
    return both.where("_take").select(*out_cols)


def sample_exact(df: DataFrame, k: int, seed: int, id_col: str = "id") -> DataFrame:
    """SMP1: exactly ``min(k, n)`` rows, seeded; ``k <= 0`` or ``k >= n`` keeps all."""
    if k <= 0:
        return df
    hd = with_hash(df, id_col, seed, "sample")
    return select_k_smallest(hd, k, "_h", id_col).drop("_h")


def split_count(n: int, valid_size: float) -> int:
    """SMP2 validation size: round-half-even of n * valid_size clamped to [1, n-1]."""
    if valid_size <= 0:
        return 0
    v = int(round(n * valid_size))
    return max(1, min(v, n - 1))


def train_valid_split(df: DataFrame, valid_size: float, seed: int, id_col: str = "id", n: int | None = None) -> DataFrame:
    """SMP2: adds ``split`` ('train' / 'valid'). The validation rows are the
    ``v`` smallest split hashes; ``valid_size <= 0`` puts everything in train."""
    if valid_size <= 0:
        return df.withColumn("split", F.lit("train"))
    n = df.count() if n is None else n
    v = split_count(n, valid_size)
    hd = with_hash(df, id_col, seed, "split")
    out = select_k_smallest(hd, v, "_h", id_col, flag="_valid")
    return out.withColumn("split", F.when(F.col("_valid"), F.lit("valid")).otherwise(F.lit("train"))).drop("_valid", "_h")


def dense_positions(df: DataFrame, seed: int, id_col: str = "id", out: str = "pos", tag: str = "shuffle", prefix_hex: int = PREFIX_HEX) -> DataFrame:
    """SMP3: a seeded shuffle numbered 0..n-1 (BIGINT). One shuffle by hash
    prefix; offsets come from the (bounded) prefix histogram."""
    hd = with_hash(df, id_col, seed, tag)
    pre = F.substring(F.col("_h"), 1, prefix_hex)
    hd = hd.withColumn("_pre", pre)
    hist = hd.groupBy("_pre").agg(F.count(F.lit(1)).alias("_c"))
    # unpartitioned window over at most 16^prefix_hex rows (the histogram only)
    ow = Window.orderBy("_pre").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hist.select("_pre", F.coalesce(F.sum("_c").over(ow), F.lit(0)).alias("_off"))
    j = hd.join(F.broadcast(offsets), "_pre")
    rw = Window.partitionBy("_pre").orderBy(F.col("_h"), F.col(id_col))
    return j.withColumn(out, (F.col("_off") + F.row_number().over(rw) - 1).cast("bigint")).drop("_h", "_pre", "_off")


def stratified_sample(df: DataFrame, category: str, k: int, seed: int, id_col: str = "id") -> DataFrame:
    """SMP5: k seeded rows per category, by each category's k-th key: no task
    gets a whole category, whatever k."""
    hd = with_hash(df, id_col, seed, "stratified")
    return select_k_smallest(hd, k, "_h", id_col, group=[category]).drop("_h")


def review_sample(df: DataFrame, k: int, seed: int, id_col: str = "id") -> DataFrame:
    """SMP6: k seeded rows for reading (top-k by hash: TakeOrderedAndProject)."""
    hd = with_hash(df, id_col, seed, "review")
    return hd.orderBy(F.col("_h"), F.col(id_col)).limit(k).drop("_h")


def proportional_quotas(df: DataFrame, category: str, k: int) -> DataFrame:
    """Largest-remainder allocation of ``k`` rows over categories in
    proportion to their sizes (ties by category). Small table: one row per category."""
    c = df.groupBy(category).agg(F.count(F.lit(1)).alias("n_c"))
    tot = Window.partitionBy()
    c = c.withColumn("n", F.sum("n_c").over(tot))
    kk = F.least(F.lit(k), F.col("n"))
    c = c.withColumn("_num", kk * F.col("n_c")).withColumn("_base", F.floor(F.col("_num") / F.col("n"))).withColumn(
        "_rem", F.col("_num") - F.col("_base") * F.col("n")
    )
    c = c.withColumn("_left", kk - F.sum("_base").over(tot))
    rw = Window.orderBy(F.col("_rem").desc(), F.col(category))
    c = c.withColumn("_r", F.row_number().over(rw))
    return c.select(category, (F.col("_base") + F.when(F.col("_r") <= F.col("_left"), 1).otherwise(0)).cast("bigint").alias("quota"))


def size_adjust(df: DataFrame, k: int, seed: int, category: str, id_col: str = "id") -> DataFrame:
    """SMP7: exactly ``min(k, n)`` rows, allocated to categories by largest remainder."""
    q = proportional_quotas(df, category, k)
    hd = with_hash(df, id_col, seed, "size")
    return select_k_smallest(hd, q, "_h", id_col, group=[category]).drop("_h")
