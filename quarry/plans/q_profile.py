"""Profiling queries (JOB4): lengths, words, describe, histogram, density, top words."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import profile as P
from quarry.plans import sqltext as S
from quarry.plans import views as V
from quarry.plans.registry import query
from quarry.sources.tables import table


def _describe_sql(src: str, measures: list[str], by: list[str]) -> str:
    """DuckDB describe over ``src`` (a FROM clause) for integer ``measures``."""
    by_sel = "".join(f"{b}, " for b in by)
    parts = " UNION ALL ".join(f"SELECT {by_sel}'{m}' AS measure, CAST({m} AS BIGINT) AS value FROM {src}" for m in measures)
    grp = ", ".join(by + ["measure"])
    return (
        f"SELECT {by_sel}measure, CAST(count(*) AS BIGINT) AS count, round_even(avg(value), 1) AS mean, "
        "round_even(stddev_samp(value), 1) AS std, min(value) AS min, "
        "round_even(quantile_cont(value, 0.25), 1) AS p25, round_even(quantile_cont(value, 0.5), 1) AS p50, "
        "round_even(quantile_cont(value, 0.75), 1) AS p75, max(value) AS max "
        f"FROM ({parts}) GROUP BY {grp}"
    )


_DOC_LEN = f"(SELECT lang, {S.char_length('text')} AS len_text, {S.word_count('text')} AS words_text FROM documents)"


@query("length_profile", _describe_sql(_DOC_LEN, ["len_text", "words_text"], ["lang"]))
def length_profile(spark, d):
    """PRJ1 + PRJ2 + AGG2 on documents, per language."""
    doc = table(spark, d, "documents").select(
        "lang", T.char_length("text").alias("len_text"), T.word_count("text").alias("words_text")
    )
    return P.describe(doc, ["len_text", "words_text"], by=["lang"])


_EX_LEN = (
    f"(SELECT {S.char_length('prompt')} AS len_prompt, {S.char_length('answer')} AS len_answer, "
    f"{S.char_length('prompt')} + {S.char_length('answer')} AS total_len FROM examples)"
)


@query("length_profile_pairs", V.with_views(_describe_sql(_EX_LEN, ["len_prompt", "len_answer", "total_len"], []), "examples"))
def length_profile_pairs(spark, d):
    """PRJ1 + AGG2 exactly as the notebook: len_prompt, len_answer, total_len."""
    ex = P.length_columns(V.examples(spark, d))
    return P.describe(ex, ["len_prompt", "len_answer", "total_len"])


_EX_TOKENS = f"(SELECT ({S.char_length('prompt')} + {S.char_length('answer')}) / 4.0 AS token_estimate FROM examples)"


@query("describe_token_estimate", V.with_views(_describe_sql(_EX_TOKENS, ["token_estimate"], []).replace("AS BIGINT) AS value", "AS DOUBLE) AS value"), "examples"))
def describe_token_estimate(spark, d):
    """AGG2 over a fraction: characters over four."""
    return P.describe(P.token_columns(V.examples(spark, d)), ["token_estimate"])


_EX_WORDS = (
    f"(SELECT {S.word_count('prompt')} AS words_prompt, {S.word_count('answer')} AS words_answer, "
    f"{S.word_count('prompt')} + {S.word_count('answer')} AS total_words FROM examples)"
)


@query("word_profile", V.with_views(_describe_sql(_EX_WORDS, ["words_prompt", "words_answer", "total_words"], []), "examples"))
def word_profile(spark, d):
    """PRJ2 + AGG2: words_prompt, words_answer, total_words."""
    ex = P.word_columns(V.examples(spark, d))
    return P.describe(ex, ["words_prompt", "words_answer", "total_words"])


@query(
    "word_counts",
    V.with_views(
        f"SELECT id, {S.word_count('prompt')} AS words_prompt, {S.word_count('answer')} AS words_answer, "
        f"{S.word_count('prompt')} + {S.word_count('answer')} AS total_words FROM examples",
        "examples",
    ),
)
def word_counts(spark, d):
    """PRJ2 per row."""
    return P.word_columns(V.examples(spark, d)).select("id", "words_prompt", "words_answer", "total_words")


@query(
    "token_estimate",
    f"SELECT doc_id, {S.char_length('text')} AS n_chars, {S.char_length('text')} / 4.0 AS token_estimate FROM documents",
)
def token_estimate(spark, d):
    """PRJ3: characters / 4 per document."""
    doc = table(spark, d, "documents")
    return doc.select("doc_id", T.char_length("text").alias("n_chars"), T.token_estimate("text").alias("token_estimate"))


_HIST_SQL = """
WITH v AS (SELECT CAST({x} AS DOUBLE) AS x FROM {src}),
s AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
b AS (SELECT CASE WHEN s.hi = s.lo THEN 0 ELSE least({bins} - 1, CAST(floor((v.x - s.lo) / ((s.hi - s.lo) / {bins}.0)) AS INTEGER)) END AS bin,
      count(*) AS cnt FROM v, s WHERE v.x IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range({bins}))
SELECT CAST(g.bin AS BIGINT) AS bin,
  s.lo + g.bin * (CASE WHEN s.hi = s.lo THEN 0.0 ELSE (s.hi - s.lo) / {bins}.0 END) AS lo_edge,
  s.lo + (g.bin + 1) * (CASE WHEN s.hi = s.lo THEN 0.0 ELSE (s.hi - s.lo) / {bins}.0 END) AS hi_edge,
  CAST(coalesce(b.cnt, 0) AS BIGINT) AS count
FROM g CROSS JOIN s LEFT JOIN b ON b.bin = g.bin
"""


@query("length_histogram", _HIST_SQL.format(x=S.char_length("text"), src="documents", bins=50))
def length_histogram(spark, d):
    """AGG4: 50 equal-width bins of document character length."""
    doc = table(spark, d, "documents").select(T.char_length("text").alias("len_text"))
    return P.histogram(doc, "len_text", 50)


_KDE_SQL = """
WITH v AS (SELECT CAST({x} AS DOUBLE) AS x FROM {src}),
s AS (SELECT min(x) AS lo, max(x) AS hi, stddev_samp(x) AS sd, count(x) AS n FROM v),
vc AS (SELECT x, count(*) AS cnt FROM v WHERE x IS NOT NULL GROUP BY x),
g AS (SELECT range AS i FROM range({grid}))
SELECT CAST(g.i AS BIGINT) AS point, round(s.lo + g.i * ((s.hi - s.lo) / ({grid} - 1.0)), 9) AS x,
  round(sum(vc.cnt * exp(-0.5 * pow(((s.lo + g.i * ((s.hi - s.lo) / ({grid} - 1.0))) - vc.x) / (s.sd * pow(CAST(s.n AS DOUBLE), -0.2)), 2)))
    / (CAST(s.n AS DOUBLE) * (s.sd * pow(CAST(s.n AS DOUBLE), -0.2)) * sqrt(2 * pi())), 12) AS density
FROM g CROSS JOIN s CROSS JOIN vc GROUP BY g.i, s.lo, s.hi, s.sd, s.n
"""


@query("length_density", _KDE_SQL.format(x=S.char_length("text"), src="documents", grid=200))
def length_density(spark, d):
    """AGG5: Gaussian KDE of document character length on 200 points."""
    doc = table(spark, d, "documents").select(T.char_length("text").alias("len_text"))
    return P.density_curve(doc, "len_text", 200)


@query(
    "top_words",
    V.with_views(
        "SELECT word, CAST(count(*) AS BIGINT) AS freq FROM (SELECT unnest("
        + S.words("lower(concat_ws(' ', prompt, answer))")
        + ") AS word FROM examples) GROUP BY word ORDER BY freq DESC, word LIMIT 10",
        "examples",
    ),
)
def top_words(spark, d):
    """AGG7 / SMP9: ten most frequent lower-cased words of prompt and answer."""
    return P.top_words(V.examples(spark, d), ["prompt", "answer"], 10).select("word", F.col("freq").cast("bigint"))


@query(
    "short_rows",
    V.with_views(
        f"SELECT CAST(count(*) AS BIGINT) AS short_rows FROM examples WHERE {S.char_length('prompt')} + {S.char_length('answer')} <= 10",
        "examples",
    ),
)
def short_rows(spark, d):
    """FLT2: number of rows with total length <= 10."""
    ex = P.length_columns(V.examples(spark, d))
    return P.short_rows(ex, "total_len", 10).agg(F.count(F.lit(1)).cast("bigint").alias("short_rows"))


@query(
    "quality_report",
    V.with_views(
        "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count_if(id IS NULL) AS BIGINT) AS id_nulls, "
        "CAST(count_if(prompt IS NULL) AS BIGINT) AS prompt_nulls, CAST(count_if(answer IS NULL) AS BIGINT) AS answer_nulls, "
        f"CAST(count_if({S.strip('answer')} = '') AS BIGINT) AS blank_answers FROM examples",
        "examples",
    ),
)
def quality_report(spark, d):
    """AGG6 + FLT4: null count per column and blank (whitespace-only) answers, one pass."""
    ex = V.examples(spark, d).select("id", "prompt", "answer")
    return ex.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        *[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"{c}_nulls") for c in ("id", "prompt", "answer")],
        F.count_if(T.strip("answer") == "").cast("bigint").alias("blank_answers"),
    )
