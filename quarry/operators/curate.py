"""Curation filters (JOB5, JOB7): category, length budget, n-gram repetition,
trace shape, batch rejection, category tagging.

Repetition is computed row-locally with higher-order functions over the
word array (no explode, no shuffle); memory is O(words) of one document.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T

# The phrase that identifies each puzzle category in a prompt.
CATEGORY_PHRASES = [
    ("bit_manipulation", "bit manipulation rule"),
    ("physics", "gravitational constant"),
    ("unit_conversion", "unit conversion"),
    ("text_encryption", "encryption rules"),
    ("numeral_system", "numeral system"),
    ("symbol_transformation", "transformation rules"),
]


def keep_where(df: DataFrame, flag: str) -> DataFrame:
    """Keep rows whose boolean column ``flag`` is true, for flags computed by
    expensive row-local expressions (regexes, n-gram arrays).

    Written as a 0-or-1-row generator rather than a Filter: a Filter would be
    pushed below the projection that computes ``flag``, duplicating the
    expression once per reference and moving it ahead of any input spreading.
    The generator keeps the work where the flag is computed, once per row."""
    one = F.when(F.col(flag), F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    return df.select(*df.columns, F.explode(one).alias("_kept")).drop("_kept", flag)


def answered_only(df: DataFrame, answer: str = "answer") -> DataFrame:
    """FLT1."""
    return df.where(F.col(answer).isNotNull())


def token_length_filter(df: DataFrame, col: str, budget: int = 2048) -> DataFrame:
    """FLT3: keep rows whose chars/4 estimate is within ``budget`` tokens."""
    return df.where(T.token_estimate(col) <= budget)


def category_filter(df: DataFrame, category: str, keep: Sequence[str]) -> DataFrame:
    """FLT7."""
    return df.where(F.col(category).isin(list(keep)))


def tag_category(prompt) -> Column:
    """PRJ15: category from its defining phrase, else 'unknown'."""
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    out = F.lit("unknown")
    for cat, phrase in reversed(CATEGORY_PHRASES):
        out = F.when(p.contains(phrase), F.lit(cat)).otherwise(out)
    return out


def ngrams(words: Column, n: int = 3) -> Column:
    """Space-joined word n-grams of a word array (empty when fewer than n words)."""
    size = F.size(words)
    return F.when(
        size >= n, F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " "))
    ).otherwise(F.array().cast("array<string>"))


def _dup_share(grams: Column) -> Column:
    return F.when(F.size(grams) > 0, 1 - F.size(F.array_distinct(grams)) / F.size(grams)).otherwise(F.lit(0.0))


def repetition_struct(text, n: int = 3, window: int = 200, step: int = 100, windowed: bool = True) -> Column:
    """FLT8 measures as one struct: ``n_words``, ``rep_share`` (duplicate n-gram
    share of the whole text) and ``rep_share_windowed`` (largest share over
    windows of ``window`` words starting every ``step`` words; texts shorter
    than one window form a single window; left out unless ``windowed``). The word and n-gram arrays are
    bound once (``let``) and reused by every window, so the cost stays linear
    even when a filter on the result is pushed below the projection."""
    per_window = window - (n - 1)

    def measures(w):
        def with_grams(g):
            nw = F.size(w)
            if not windowed:
                return F.struct(nw.cast("bigint").alias("n_words"), _dup_share(g).alias("rep_share"))
            starts = F.sequence(F.lit(0), F.greatest(nw - window, F.lit(0)), F.lit(step))
            win = F.array_max(F.transform(starts, lambda s: _dup_share(F.slice(g, s + 1, per_window))))
            return F.struct(
                nw.cast("bigint").alias("n_words"),
                _dup_share(g).alias("rep_share"),
                F.when(nw >= n, win).otherwise(F.lit(0.0)).alias("rep_share_windowed"),
            )

        return T.let(ngrams(w, n), with_grams)

    return T.let(T.words(text), measures)


def repetition_columns(df: DataFrame, text: str, n: int = 3, window: int = 200, step: int = 100) -> DataFrame:
    """Adds ``n_words``, ``rep_share``, ``rep_share_windowed`` (see ``repetition_struct``)."""
    r = df.withColumn("_rep", repetition_struct(text, n, window, step))
    return r.select(*df.columns, "_rep.n_words", "_rep.rep_share", "_rep.rep_share_windowed")


def _least_distinct(words: list[str], n: int, window: int, step: int) -> float:
    """Largest duplicate share of the n-grams in windows of ``window`` words, one every ``step`` words.

    N-grams are numbered exactly, pair by pair. One that stands at i and last stood at
    p is the first of its kind in every window that starts after p and reaches i, so the
    distinct n-grams of all windows are one running sum: time does not depend on ``step``."""
    if len(words) < n:
        return 0.0
    ids = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)
    m, grams, kinds = len(words) - n + 1, ids, int(ids.max()) + 1
    for k in range(1, n):
        grams = pd.factorize(grams[:-1] * kinds + ids[k:])[0].astype(np.int64)
    size = min(window - n + 1, m)
    order = np.argsort(grams, kind="stable")
    again = grams[order[1:]] == grams[order[:-1]]
    before = np.full(m, -1)
    before[order[1:][again]] = order[:-1][again]
    at = np.arange(m)
    first, last = np.maximum(before + 1, at - size + 1), np.minimum(at, m - size)
    ok = first <= last
    change = np.bincount(first[ok], minlength=m + 1) - np.bincount(last[ok] + 1, minlength=m + 1)
    return 1 - int(np.cumsum(change)[: m - size + 1 : step].min()) / size


def sliding_repetition(df: DataFrame, text: str, n: int = 3, window: int = 200, step: int = 1) -> DataFrame:
    """FLT8 with a window at any step, one word too: adds ``rep_share_sliding``.

    Linear in the text for every step (``repetition_struct`` does window / step
    times that, without Python). Texts of fewer than n words, and null, have
    share 0; texts shorter than a window are one window."""
    if not n <= window or step < 1:
        raise ValueError("window must hold an n-gram, step be positive")

    @F.pandas_udf("double")
    def share(texts: pd.Series) -> pd.Series:
        return pd.Series([_least_distinct(t.split(), n, window, step) if t else 0.0 for t in texts], dtype="float64")

    return df.withColumn("rep_share_sliding", share(F.col(text)))


def repetition_filter(df: DataFrame, text: str, threshold: float = 0.30, windowed: bool = False, **kw) -> DataFrame:
    """FLT8: drop rows whose duplicate n-gram share exceeds ``threshold``."""
    if windowed:
        m = repetition_columns(df, text, **kw)
        return keep_where(m.withColumn("_rep_ok", F.col("rep_share_windowed") <= threshold), "_rep_ok")
    m = df.withColumn("_rep", repetition_struct(text, windowed=False, **kw)).select(*df.columns, "_rep.n_words", "_rep.rep_share")
    return keep_where(m.withColumn("_rep_ok", F.col("rep_share") <= threshold), "_rep_ok")


def trace_struct(response, min_words: int = 20, max_words: int = 6000) -> Column:
    """PRJ7 + FLT10/FLT11 as one struct (trace, answer_value, trace_words, keep);
    trace, answer and word count are each computed once and bound (``let``), so a
    filter on ``keep`` pushed below other operators evaluates each once, not per use."""

    def with_trace(r):
        def with_words(t):
            def with_answer(words):
                def fields(a):
                    keep = r.isNotNull() & t.isNotNull() & a.isNotNull() & words.between(min_words, max_words)
                    return F.struct(t.alias("trace"), a.alias("answer_value"), words.alias("trace_words"), keep.alias("keep"))

                return T.let(T.extract_tag(r, "answer"), fields)

            return T.let(T.word_count(t), with_answer)

        return T.let(T.extract_tag(r, "think"), with_words)

    return T.let(F.col(response) if isinstance(response, str) else response, with_trace)


def trace_columns(df: DataFrame, response: str, min_words: int = 20, max_words: int = 6000) -> DataFrame:
    """PRJ7 + word count of the trace (+ ``keep`` for the trace filter)."""
    t = df.withColumn("_tr", trace_struct(response, min_words, max_words))
    return t.select(*df.columns, "_tr.trace", "_tr.answer_value", "_tr.trace_words", "_tr.keep")


def trace_filter(df: DataFrame, response: str, min_words: int = 20, max_words: int = 6000) -> DataFrame:
    """FLT10 + FLT11: an answer tag is present and the trace length is within bounds."""
    return keep_where(trace_columns(df, response, min_words, max_words), "keep")


def batch_defect_rates(df: DataFrame, batch: str = "batch", defect: str = "defect") -> DataFrame:
    return df.groupBy(batch).agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.avg(defect).alias("defect_rate"))


def rejected_batches(df: DataFrame, batch: str = "batch", defect: str = "defect", max_rate: float = 0.10) -> DataFrame:
    """Batches whose rated rows exceed ``max_rate``, as _bad_batch."""
    return batch_defect_rates(df, batch, defect).where(F.col("defect_rate") > max_rate).select(F.col(batch).alias("_bad_batch"))


def batch_rejection(df: DataFrame, batch: str = "batch", defect: str = "defect", max_rate: float = 0.10) -> DataFrame:
    """FLT12: drop whole batches whose defect rate exceeds ``max_rate``.

    The rate is taken over the rated rows; unrated rows go or stay with their
    batch, and a batch without any rated row stays (nothing speaks against it).

    The per-batch table is one row per batch (partial aggregation first, so a
    huge batch is never collected in one task); the drop side is a left-anti
    join that Spark broadcasts when the batch table is small."""
    bad = rejected_batches(df, batch, defect, max_rate)
    return df.join(bad, df[batch].eqNullSafe(bad["_bad_batch"]), "left_anti")
