"""Projection queries: normalisation, extraction, parsing, rendering, numerals."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import numbers as N
from quarry.functions import text as T
from quarry.plans import sqltext as S
from quarry.plans import views as V
from quarry.plans.registry import query
from quarry.sources.tables import table


@query(
    "normalize_answer",
    V.with_views(
        f"SELECT id, {S.raw_answer('answer')} AS raw_answer, {S.normalize_answer('answer')} AS normalized_answer FROM pairs",
        "pairs",
    ),
)
def normalize_answer(spark, d):
    """PRJ4 / PRJ5 over every answer."""
    p = V.pairs(spark, d)
    return p.select("id", T.raw_answer("answer").alias("raw_answer"), T.normalize_answer("answer").alias("normalized_answer"))


@query(
    "extract_final_answer",
    V.with_views(f"SELECT id, {S.extract_final_answer('raw_generation')} AS prediction FROM generations", "generations"),
)
def extract_final_answer(spark, d):
    """PRJ6 over every generation."""
    g = V.generations(spark, d)
    return g.select("id", T.extract_final_answer("raw_generation").alias("prediction"))


@query(
    "extract_trace",
    V.with_views(
        f"SELECT doc_id, {S.extract_tag('response', 'think')} AS trace, {S.extract_tag('response', 'answer')} AS answer_value FROM traces",
        "traces",
    ),
)
def extract_trace(spark, d):
    """PRJ7: think trace and answer value of each traced response (null when the tag is absent)."""
    t = V.traces(spark, d)
    return t.select("doc_id", T.extract_tag("response", "think").alias("trace"), T.extract_tag("response", "answer").alias("answer_value"))


@query(
    "parse_generated_puzzle",
    V.with_views(f"SELECT id, {S.parse_prompt('text')} AS prompt, {S.parse_answer('text')} AS answer FROM gens", "gens"),
)
def parse_generated_puzzle(spark, d):
    """PRJ8 (+ FLT5: null unless both parts are non-empty)."""
    g = V.gens(spark, d)
    return g.select("id", T.parse_prompt("text").alias("prompt"), T.parse_answer("text").alias("answer"))


_CHAT_T = "'<|im_start|>user' || chr(10) || prompt || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)"


@query("chat_training_text", V.with_views(f"SELECT id, {_CHAT_T} || answer || '<|im_end|>' AS text FROM pairs", "pairs"))
def chat_training_text(spark, d):
    """PRJ9 / SNK4 rows: training text of every answered example."""
    p = V.pairs(spark, d)
    return p.select("id", T.render_training_text("prompt", "answer").alias("text"))


@query("chat_generation_prompt", V.with_views(f"SELECT id, {_CHAT_T} AS text FROM examples", "examples"))
def chat_generation_prompt(spark, d):
    """PRJ10: generation prompt of every example (answered or not)."""
    e = V.examples(spark, d)
    return e.select("id", T.render_generation_prompt("prompt").alias("text"))


@query(
    "head_preview",
    V.with_views("SELECT id, substr(prompt, 1, 200) AS preview, answer FROM examples ORDER BY id LIMIT 5", "examples"),
)
def head_preview(spark, d):
    """SMP8 + PRJ14: first five rows by id with a 200-character prompt preview."""
    e = V.examples(spark, d)
    return e.orderBy("id").limit(5).select("id", T.preview("prompt", 200).alias("preview"), "answer")


@query(
    "truncate_to_budget",
    f"SELECT doc_id, substr(text, 1, {2048 * 4}) AS text, {S.char_length(f'substr(text, 1, {2048 * 4})')} AS n_chars FROM documents",
)
def truncate_to_budget(spark, d):
    """PRJ18: shorten documents to the 2,048-token budget (chars/4 estimate)."""
    doc = table(spark, d, "documents")
    t = T.truncate_to_budget("text", 2048)
    return doc.select("doc_id", t.alias("text"), T.char_length(t).alias("n_chars"))


_N = "(p_partkey * 7 - 20)"


@query(
    "roman_numerals",
    f"SELECT p_partkey, {_N} AS n, {S.int_to_roman(_N)} AS roman FROM part",
)
def roman_numerals(spark, d):
    """PRJ11 over one number per part row: negative ones, zero, and beyond 3,999."""
    p = table(spark, d, "part")
    n = (F.col("p_partkey") * 7 - 20).cast("bigint")
    return p.select("p_partkey", n.alias("n"), N.int_to_roman(n).alias("roman"))


@query(
    "canonical_answer",
    V.with_views(
        f"SELECT id, {S.canonical_value('prediction')} AS canonical_value, {S.canonical_text('prediction')} AS canonical_text "
        f"FROM (SELECT id, {S.extract_final_answer('raw_generation')} AS prediction FROM generations)",
        "generations",
    ),
)
def canonical_answer(spark, d):
    """PRJ17 over every extracted prediction."""
    g = V.generations(spark, d).select("id", T.extract_final_answer("raw_generation").alias("prediction"))
    return g.select("id", T.canonical_value("prediction").alias("canonical_value"), T.canonical_text("prediction").alias("canonical_text"))
