"""Curation queries (JOB5 / JOB7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import curate as C
from quarry.plans import sqltext as S
from quarry.plans import views as V
from quarry.plans.registry import query
from quarry.sources.tables import table


@query(
    "token_length_filter",
    f"SELECT doc_id, {S.char_length('text')} AS n_chars FROM documents WHERE {S.char_length('text')} / 4.0 <= 2048",
)
def token_length_filter(spark, d):
    """FLT3: documents within the 2,048-token budget (chars/4)."""
    doc = table(spark, d, "documents")
    return C.token_length_filter(doc, "text", 2048).select("doc_id", T.char_length("text").alias("n_chars"))


@query("category_filter", "SELECT doc_id, lang, source FROM documents WHERE lang IN ('en', 'de')")
def category_filter(spark, d):
    """FLT7: keep chosen categories (languages here)."""
    doc = table(spark, d, "documents").select("doc_id", "lang", "source")
    return C.category_filter(doc, "lang", ["en", "de"])


def _share_sql(x: str) -> str:
    return f"(CASE WHEN len({x}) > 0 THEN 1 - len(list_distinct({x})) / len({x}) ELSE 0.0 END)"


_GRAMS = (
    "SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n_words, CASE WHEN len(w) >= 3 THEN "
    "list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) ELSE [] END AS g "
    f"FROM (SELECT doc_id, {S.words('text')} AS w FROM documents)"
)
_REP = (
    f"SELECT doc_id, n_words, {_share_sql('g')} AS rep_share, "
    "CASE WHEN n_words >= 3 THEN list_max(list_transform(range(0, greatest(n_words - 200, 0) + 1, 100), "
    f"lambda s: {_share_sql('g[s + 1:s + 198]')})) ELSE 0.0 END AS rep_share_windowed FROM ({_GRAMS})"
)


@query("ngram_repetition", f"SELECT doc_id, n_words, rep_share, rep_share <= 0.3 AS keep FROM ({_REP})")
def ngram_repetition(spark, d):
    """FLT8: duplicate word-trigram share of every whole document; keep <= 0.30."""
    doc = table(spark, d, "documents").select("doc_id", "text")
    m = C.repetition_columns(doc, "text")
    return m.select("doc_id", "n_words", "rep_share", (F.col("rep_share") <= 0.3).alias("keep"))


@query(
    "ngram_repetition_windowed",
    f"SELECT doc_id, n_words, rep_share_windowed, rep_share_windowed <= 0.3 AS keep FROM ({_REP})",
)
def ngram_repetition_windowed(spark, d):
    """FLT8 (sliding window): largest share over 200-word windows every 100 words."""
    doc = table(spark, d, "documents").select("doc_id", "text")
    m = C.repetition_columns(doc, "text")
    return m.select("doc_id", "n_words", "rep_share_windowed", (F.col("rep_share_windowed") <= 0.3).alias("keep"))


_SLIDING = f"""WITH w AS (SELECT doc_id, {S.words('text')} AS w FROM documents),
g AS (SELECT doc_id, len(w) AS nw, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
o AS (SELECT doc_id, nw, i, [w[i], w[i + 1], w[i + 2]] AS gram FROM g),
p AS (SELECT doc_id, nw, i, coalesce(lag(i) OVER (PARTITION BY doc_id, gram ORDER BY i), 0) AS before, least(198, nw - 2) AS size FROM o),
s AS (SELECT doc_id, size, greatest(before + 1, i - size + 1) AS a, least(i, nw - 1 - size) AS b FROM p),
e AS (SELECT doc_id, size, a AS pos, 1 AS d FROM s WHERE a <= b UNION ALL SELECT doc_id, size, b + 1, -1 FROM s WHERE a <= b),
c AS (SELECT doc_id, size, pos, sum(d) AS d FROM e GROUP BY doc_id, size, pos),
r AS (SELECT doc_id, size, pos, sum(d) OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM c),
m AS (SELECT doc_id, 1 - min(n) FILTER (WHERE n > 0) / any_value(size) AS share FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(m.share, 0.0) AS rep_share_sliding, coalesce(m.share, 0.0) <= 0.3 AS keep FROM documents d LEFT JOIN m USING (doc_id)"""


@query("ngram_repetition_sliding", f"SELECT * FROM ({_SLIDING})")
def ngram_repetition_sliding(spark, d):
    """FLT8 (a window at every word): largest share over 200-word windows."""
    m = C.sliding_repetition(table(spark, d, "documents").select("doc_id", "text"), "text")
    return m.select("doc_id", "rep_share_sliding", (F.col("rep_share_sliding") <= 0.3).alias("keep"))


@query(
    "trace_filter",
    V.with_views(
        f"SELECT doc_id, trace_words FROM (SELECT doc_id, {S.extract_tag('response', 'think')} AS trace, "
        f"{S.extract_tag('response', 'answer')} AS answer_value, {S.word_count(S.extract_tag('response', 'think'))} AS trace_words "
        "FROM traces) WHERE answer_value IS NOT NULL AND trace IS NOT NULL AND trace_words BETWEEN 20 AND 6000",
        "traces",
    ),
)
def trace_filter(spark, d):
    """FLT10 + FLT11 over every traced response."""
    t = V.traces(spark, d)
    return C.trace_filter(t, "response", 20, 6000).select("doc_id", "trace_words")


@query(
    "batch_rejection",
    V.with_views(
        "SELECT doc_id, batch FROM batches WHERE batch NOT IN (SELECT batch FROM batches GROUP BY batch HAVING avg(defect) > 0.1)",
        "batches",
    ),
)
def batch_rejection(spark, d):
    """FLT12: documents of batches (sources) whose defect rate is at most 10 %."""
    b = V.batches(spark, d)
    return C.batch_rejection(b, "batch", "defect", 0.10).select("doc_id", "batch")
