"""Vocabulary queries (AGG10): word counts and seed pieces with their oracles, and
the sweep and the cut by its pieces, which have none: EM fitting is iterative;
tests check the lattice kernels against brute-force enumeration instead."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import tokenizer as TK
from quarry.plans import sqltext as S
from quarry.plans import views as V
from quarry.plans.registry import query
from quarry.sources.tables import table


@query("token_count_by_vocab")
def token_count_by_vocab(spark, d):
    """AGG10: unigram vocabularies of 4,000 / 8,000 / 16,000 pieces fitted on every
    example's prompt + answer; total tokens over all prompts per size."""
    return TK.vocabulary_sweep(V.examples(spark, d), (4000, 8000, 16000))


@query("truncate_to_pieces")
def truncate_to_pieces(spark, d):
    """PRJ18 in real pieces: every document cut after its 2,048th piece, by a vocabulary of
    4,000 pieces fitted on every example's prompt + answer."""
    model = TK.fit_sweep(TK.word_frequencies(V.examples(spark, d), ("prompt", "answer")), (4000,))[4000]
    cut = TK.truncate_to_pieces(table(spark, d, "documents").select("doc_id", "text"), model, 2048)
    return cut.select("doc_id", "n_pieces", F.length("text_cut").cast("bigint").alias("kept_chars"), "text_cut")


_WORDS_SQL = f"""SELECT '▁' || w AS word, count(*) AS freq FROM (SELECT unnest({S.words("concat_ws(' ', prompt, answer)")}) AS w FROM examples) GROUP BY w"""
V.register_sql_view("vocab_words", ["examples"], _WORDS_SQL)


@query("vocabulary_words", V.with_views("SELECT * FROM vocab_words", "vocab_words"))
def vocabulary_words(spark, d):
    """AGG10, first step: every marked word of prompt + answer with its count."""
    return TK.word_frequencies(V.examples(spark, d), ("prompt", "answer"))


_SEEDS_SQL = """WITH c AS (SELECT piece, sum(freq)::BIGINT AS freq FROM (
  SELECT freq, array_to_string(u[i:i + n - 1], '') AS piece FROM (SELECT freq, u, n, unnest(range(1, len(u) - n + 2)) AS i
    FROM (SELECT freq, string_split(word, '') AS u, unnest(range(1, 17)) AS n FROM vocab_words) WHERE len(u) >= n)) GROUP BY piece)
SELECT * FROM c WHERE length(piece) = 1
UNION ALL (SELECT * FROM c WHERE length(piece) > 1 ORDER BY freq * length(piece) DESC, piece LIMIT 40000)"""


@query("vocabulary_seeds", V.with_views("SELECT * FROM (" + _SEEDS_SQL + ")", "vocab_words"))
def vocabulary_seeds(spark, d):
    """AGG10, second step: every character and the 40,000 substrings of most weight (top-k is the feature)."""
    return TK.seed_pieces(TK.word_frequencies(V.examples(spark, d), ("prompt", "answer")), 40_000)
