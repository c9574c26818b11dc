"""Dataset profiling: exact describe, histogram, density curve, top words, counts.

Statistics are exact. Percentiles and moments are computed from a
value-count table (``groupBy(value).count()`` is partially aggregated on the
map side). Percentiles of a measure with more than ``MAX_DISTINCT`` distinct
values are selected by refining histograms, so no buffer holds them all. The
density curve is a sum over bins with a stated error bound.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.session import materialize

QUANTILES = (0.25, 0.5, 0.75)
# Distinct values of one measure and group that a single percentile buffer may hold.
MAX_DISTINCT = 100_000
# Rank rows (six a measure and group) up to which the open ranges are broadcast.
MAX_STATE = 60_000

_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _melt(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Long format (by..., measure, value) without a shuffle: BIGINT where every
    measure is a whole number, else DOUBLE. Nulls are no values."""
    kind = "bigint" if all(df.schema[c].dataType.simpleString() in _WHOLE for c in cols) else "double"
    pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast(kind).alias("value")) for c in cols])
    return df.select(*by, F.inline(pairs)).where(F.col("value").isNotNull())


def value_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return _melt(df, cols, by).groupBy(*by, "measure", "value").agg(F.count(F.lit(1)).alias("cnt"))


def _coarse(v: Column) -> Column:
    """A rising function of a number with about 72,000 values: sign, exponent and four more bits."""
    x = v.cast("double")
    size = F.when(F.abs(x) == F.lit(math.inf), F.lit(40_000)).otherwise(F.floor(F.log2(F.abs(x)) * 16).cast("int") + 20_000)
    return F.when(F.isnan(x), F.lit(50_000)).when(x == 0, F.lit(0)).when(x > 0, size).otherwise(-size)


def exact_quantiles(vc: DataFrame, keys: Sequence[str], quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """keys, pct (array): linearly interpolated quantiles of weighted values
    (``value``, ``cnt``) per key, by distributed selection.

    Each wanted rank keeps the range of values it must lie in. A pass counts the
    values of every open range in at most about 72,000 buckets (first by exponent,
    then in equal widths), and the rank moves into its bucket's own minimum and
    maximum, until they are equal. A range shrinks by the factor 65,535 a pass, so
    doubles need five passes at most. No task or buffer holds more than one
    range's buckets, however many distinct values there are."""
    rows = vc.select(F.struct(*keys).alias("_g"), F.col("value").alias("_v"), F.col("cnt").alias("_c"))
    sizes = rows.groupBy("_g").agg(F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    places = F.array(*[F.lit(float(q)) * (F.col("_n") - 1) for q in quantiles])
    ranks = F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(F.floor(p), F.ceil(p)))))
    state = materialize(sizes.select("_g", "_n", F.explode(ranks).alias("_r"), "_lo", "_hi", F.lit(0).cast("bigint").alias("_before")))
    small = state.count() <= MAX_STATE
    bucket = _coarse(F.col("_v"))
    is_open = F.col("_lo") != F.col("_hi")
    span = ["_g", "_lo", "_hi"]
    while state.where(is_open).limit(1).count():
        ranges = state.where(is_open).select(*span).distinct()
        inside = rows.join(F.broadcast(ranges) if small else ranges, "_g").where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        hist = inside.groupBy(*span, bucket.alias("_b")).agg(F.sum("_c").alias("_k"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
        hist = hist.withColumn("_upto", F.sum("_k").over(Window.partitionBy(*span).orderBy("_b")))
        at = F.col("_r") - F.col("_before")
        hit = state.where(is_open).join(hist, span).where((at < F.col("_upto")) & (at >= F.col("_upto") - F.col("_k")))
        moved = hit.select("_g", "_n", "_r", F.col("_min").alias("_lo"), F.col("_max").alias("_hi"), (F.col("_before") + F.col("_upto") - F.col("_k")).alias("_before"))
        state = materialize(moved.unionByName(state.where(~is_open)))
        width = (F.col("_hi") - F.col("_lo")).cast("double")
        bucket = F.floor((F.col("_v") - F.col("_lo")).cast("double") / width * 65_535).cast("int")
    per = state.groupBy("_g", "_n").agg(F.map_from_entries(F.collect_list(F.struct("_r", F.col("_lo").cast("double")))).alias("_at"))

    def between(p):
        low, high = F.element_at("_at", F.floor(p)), F.element_at("_at", F.ceil(p))
        return F.when(low == high, low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high)

    return per.select("_g", F.transform(places, between).alias("pct")).select(*[F.col("_g")[k].alias(k) for k in keys], "pct")


def _with_quantiles(vc: DataFrame, keys: Sequence[str], max_distinct: int, **aggs: Column) -> DataFrame:
    """``aggs`` and ``pct`` per key; ``percentile`` where its buffers stay below ``max_distinct`` values."""
    named = [c.alias(k) for k, c in aggs.items()]
    if not vc.groupBy(*keys).count().where(F.col("count") > max_distinct).limit(1).count():
        return vc.groupBy(*keys).agg(*named, F.percentile(F.col("value"), F.array(*[F.lit(x) for x in QUANTILES]), F.col("cnt")).alias("pct"))
    q = exact_quantiles(vc, keys).select(*[F.col(k).alias(f"_{k}") for k in keys], "pct")
    return vc.groupBy(*keys).agg(*named).join(q, _same(keys)).drop(*[f"_{k}" for k in keys])


def _same(keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return same


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), decimals: int = 1, max_distinct: int = MAX_DISTINCT) -> DataFrame:
    """pandas ``describe().round(1)`` per measure: count, mean, std (n-1), min,
    25/50/75 % (linear interpolation), max. Rounding is half-even like numpy.

    Whole numbers: moments use exact DECIMAL(38,0) sums of the value counts, so
    the variance has no cancellation error however many rows there are. Other
    measures keep their fractions; their variance is summed around the mean.
    Nulls are left out, as pandas does. Where a measure and group has more than
    ``max_distinct`` distinct values, ``exact_quantiles`` selects the percentiles;
    the result is the same.
    """
    vc = value_counts(df, cols, by)
    if dict(vc.dtypes)["value"] == "double":
        return _describe_doubles(vc, by, decimals, max_distinct)
    dec = "decimal(38,0)"
    c = F.col("cnt").cast(dec)
    v = F.col("value").cast(dec)
    agg = _with_quantiles(
        materialize(vc), [*by, "measure"], max_distinct, n=F.sum("cnt"), s1=F.sum(c * v), s2=F.sum(c * v * v), min=F.min("value"), max=F.max("value")
    )
    n = F.col("n").cast(dec)
    var_num = (n * F.col("s2") - F.col("s1") * F.col("s1")).cast("double")
    var_den = (n * (n - F.lit(1))).cast("double")
    std = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.lit(0.0), var_num / var_den)))
    mean = F.col("s1").cast("double") / F.col("n").cast("double")

    def r(x: Column) -> Column:
        return F.bround(x, decimals)

    return agg.select(
        *by,
        "measure",
        F.col("n").cast("bigint").alias("count"),
        r(mean).alias("mean"),
        r(std).alias("std"),
        F.col("min").cast("bigint").alias("min"),
        r(F.col("pct")[0]).alias("p25"),
        r(F.col("pct")[1]).alias("p50"),
        r(F.col("pct")[2]).alias("p75"),
        F.col("max").cast("bigint").alias("max"),
    )


def _describe_doubles(vc: DataFrame, by: Sequence[str], decimals: int, max_distinct: int) -> DataFrame:
    keys = [*by, "measure"]
    mu = F.sum(F.col("cnt") * F.col("value")) / F.sum("cnt")
    vc = materialize(vc)
    first = _with_quantiles(vc, keys, max_distinct, n=F.sum("cnt"), mu=mu, min=F.min("value"), max=F.max("value"))
    around = vc.select(*[F.col(k).alias(f"_{k}") for k in keys], "value", "cnt")
    dev = around.join(first, _same(keys)).groupBy(*keys, "n", "mu", "min", "max", "pct").agg(F.sum(F.col("cnt") * F.pow(F.col("value") - F.col("mu"), 2)).alias("ss"))

    def r(x: Column) -> Column:
        return F.bround(x, decimals)

    std = F.when(F.col("n") > 1, F.sqrt(F.try_divide(F.col("ss"), (F.col("n") - 1).cast("double"))))
    return dev.select(
        *keys, F.col("n").cast("bigint").alias("count"), r(F.col("mu")).alias("mean"), r(std).alias("std"), F.col("min"),
        r(F.col("pct")[0]).alias("p25"), r(F.col("pct")[1]).alias("p50"), r(F.col("pct")[2]).alias("p75"), F.col("max"),
    )


def token_columns(df: DataFrame, prompt: str = "prompt", answer: str = "answer", chars_per_token: float = 4.0) -> DataFrame:
    """token_estimate: characters of both texts over ``chars_per_token``, a fraction."""
    return df.withColumn("token_estimate", (T.char_length(prompt) + T.char_length(answer)) / F.lit(chars_per_token))


def length_columns(df: DataFrame, prompt: str = "prompt", answer: str = "answer") -> DataFrame:
    """len_prompt, len_answer, total_len (code points; null counts 0)."""
    return df.withColumn("len_prompt", T.char_length(prompt)).withColumn("len_answer", T.char_length(answer)).withColumn(
        "total_len", F.col("len_prompt") + F.col("len_answer")
    )


def word_columns(df: DataFrame, prompt: str = "prompt", answer: str = "answer") -> DataFrame:
    return df.withColumn("words_prompt", T.word_count(prompt)).withColumn("words_answer", T.word_count(answer)).withColumn(
        "total_words", F.col("words_prompt") + F.col("words_answer")
    )


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram over [min, max], last bin closed (numpy semantics).

    min / max enter as scalar subqueries (one tiny job), so the binning is a
    single map-side pass plus a partial aggregate of at most ``bins`` keys.
    Every bin is returned, empty ones with count 0.
    """
    x = F.col(col).cast("double")
    # one scalar subquery (one pass) for both bounds
    stats = df.select(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    lo, hi = stats["lo"], stats["hi"]
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.lit(bins - 1), F.floor((x - lo) / width).cast("int")))
    counts = df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = grid.join(F.broadcast(counts), "bin", "left")
    w = F.when(hi == lo, F.lit(0.0)).otherwise(width)
    return out.select(
        F.col("bin").cast("bigint").alias("bin"),
        (lo + F.col("bin") * w).alias("lo_edge"),
        (lo + (F.col("bin") + 1) * w).alias("hi_edge"),
        F.coalesce(F.col("cnt"), F.lit(0)).cast("bigint").alias("count"),
    )


# Terms, bin width and reach of the density curve, in bandwidths.
TERMS, BIN, REACH = 13, 0.25, 8.5


def _hermite(k: int) -> list[int]:
    """Coefficients of the k-th (probabilists') Hermite polynomial, lowest power first."""
    old, new = [0], [1]
    for j in range(k):
        shifted = [0, *new]
        old, new = new, [a - j * b for a, b in zip(shifted, [*old, *[0] * (len(shifted) - len(old))])]
    return new


def density_curve(df: DataFrame, col: str, gridsize: int = 200, decimals: int = 12) -> DataFrame:
    """Gaussian KDE on ``gridsize`` points over [min, max], Scott bandwidth
    ``sd * n^-0.2`` (the kernel seaborn draws over a histogram).

    Values fall into bins a quarter of a bandwidth h wide. A bin keeps the sums of
    ((x - middle)/h)^k for k < 13, from which its part of the curve is a Taylor
    (Hermite) series, added to the grid points within 8.5 h of it. Per value the
    series errs by at most 1.1 * 0.125^13 / sqrt(13!) < 1e-16 of the kernel's peak
    and the cut by less than 3e-15 (8.5 less half a bin), far below 1e-9 of the curve's
    scale. Rows made: bins that hold values, times the points in reach; the
    values themselves are only summed on the map side. A single row or equal
    values have no bandwidth: no curve (no rows).
    """
    x = F.col(col).cast("double")
    stats = df.select(
        F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"), F.stddev_samp(x).alias("sd"), F.count(x).alias("n"))
    ).scalar()
    lo, hi, sd, n = (stats[c] for c in ("lo", "hi", "sd", "n"))
    h = F.nullif(sd * F.pow(n.cast("double"), F.lit(-0.2)), F.lit(0.0))
    step = (hi - lo) / F.lit(float(gridsize - 1))
    v = df.where(F.col(col).isNotNull()).select(x.alias("x"), h.alias("h"), lo.alias("lo"), step.alias("step")).where(F.col("h").isNotNull())
    v = v.withColumn("b", F.floor((F.col("x") - F.col("lo")) / (F.col("h") * BIN)))
    v = v.withColumn("t", (F.col("x") - F.col("lo")) / F.col("h") - (F.col("b") + 0.5) * BIN)
    power, powers = F.lit(1.0), []
    for k in range(TERMS):
        powers.append(F.sum(power).alias(f"m{k}"))
        power = F.pow(F.col("t"), F.lit(float(k + 1)))
    bins = v.groupBy("b", "h", "lo", "step").agg(*powers)
    series = [_hermite(k) for k in range(TERMS)]
    weight = [sum((F.col(f"m{k}") * (series[k][p] / math.factorial(k)) for k in range(p, TERMS) if series[k][p]), F.lit(0.0)).alias(f"c{p}") for p in range(TERMS)]
    middle = (F.col("b") + 0.5) * BIN  # in bandwidths from lo
    reach = [(middle + r) * F.col("h") / F.col("step") for r in (-REACH, REACH)]
    first, last = F.greatest(F.ceil(reach[0]), F.lit(0)), F.least(F.floor(reach[1]), F.lit(gridsize - 1))
    pts = bins.where(first <= last).select(*weight, "h", "lo", "step", middle.alias("mid"), F.explode(F.sequence(first, last)).alias("i"))
    u = pts.withColumn("u", F.col("i") * F.col("step") / F.col("h") - F.col("mid"))
    value = F.col(f"c{TERMS - 1}")
    for p in reversed(range(TERMS - 1)):
        value = value * F.col("u") + F.col(f"c{p}")
    near = u.groupBy("i").agg(F.sum(value * F.exp(-0.5 * F.col("u") * F.col("u"))).alias("s"))
    grid = df.sparkSession.range(gridsize).select(F.col("id").alias("i"))
    norm = n.cast("double") * h * F.lit((2 * math.pi) ** 0.5)
    return grid.join(F.broadcast(near), "i", "left").select(
        F.col("i").cast("bigint").alias("point"),
        F.round(lo + F.col("i") * step, 9).alias("x"),
        F.round(F.try_divide(F.coalesce(F.col("s"), F.lit(0.0)), norm), decimals).alias("density"),
    ).where(F.col("density").isNotNull())


def top_words(df: DataFrame, cols: Sequence[str] = ("prompt", "answer"), k: int = 10) -> DataFrame:
    """Most frequent lower-cased whitespace-split words of the given columns;
    ties broken by the word. Partial aggregation keeps hot words cheap."""
    w = df.select(F.explode(T.words(F.lower(F.concat_ws(" ", *[F.col(c) for c in cols])))).alias("word"))
    counts = w.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    return counts.orderBy(F.col("freq").desc(), F.col("word")).limit(k)


def category_counts(df: DataFrame, category: str = "category") -> DataFrame:
    """Count per category, sorted by category, with its share of all rows."""
    c = df.groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    # total over the per-category table (one row per category), not a second scan
    total = F.sum("n").over(Window.partitionBy())
    return c.select(category, F.col("n").cast("bigint").alias("n"), (F.col("n") / total).alias("share")).orderBy(category)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: ``<col>_nulls`` per column, in one pass."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"{c}_nulls") for c in cols])


def short_rows(df: DataFrame, total_len: str = "total_len", max_len: int = 10) -> DataFrame:
    """Rows whose total length is at most ``max_len`` (degenerate data)."""
    return df.where(F.col(total_len) <= max_len)
