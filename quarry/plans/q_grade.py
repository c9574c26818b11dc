"""Grading queries (JOB2): predictions, accuracy, voting, rewards, error classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.exact import exact_value
from quarry.operators import grade as G
from quarry.plans import sqltext as S
from quarry.plans import views as V
from quarry.plans.registry import query

_PRED = (
    f"SELECT id, prediction, raw_generation, answer, "
    f"CASE WHEN answer IS NOT NULL THEN {S.raw_answer('prediction')} = {S.raw_answer('answer')} END AS raw_exact, "
    f"CASE WHEN answer IS NOT NULL THEN {S.normalize_answer('prediction')} = {S.normalize_answer('answer')} END AS normalized_exact "
    f"FROM (SELECT id, {S.extract_final_answer('raw_generation')} AS prediction, raw_generation, answer FROM generations)"
)
V.register_sql_view("predictions", ["generations"], _PRED)


def _pred(spark, d):
    return G.predictions(V.generations(spark, d))


@query(
    "prediction_table",
    V.with_views(
        "SELECT id, prediction, raw_generation, coalesce(answer, '') AS answer, "
        "CASE WHEN answer IS NULL THEN '' WHEN raw_exact THEN 'True' ELSE 'False' END AS raw_exact, "
        "CASE WHEN answer IS NULL THEN '' WHEN normalized_exact THEN 'True' ELSE 'False' END AS normalized_exact FROM predictions",
        "predictions",
    ),
)
def prediction_table(spark, d):
    """SNK2 rows: the prediction CSV content."""
    return G.prediction_table(_pred(spark, d))


@query(
    "exact_match_accuracy",
    V.with_views(
        "SELECT * FROM (SELECT CAST(count(*) AS BIGINT) AS num_rows, avg(CAST(raw_exact AS INTEGER)) AS raw_exact_accuracy, "
        "avg(CAST(normalized_exact AS INTEGER)) AS normalized_exact_accuracy FROM predictions WHERE answer IS NOT NULL) "
        "WHERE num_rows > 0",
        "predictions",
    ),
)
def exact_match_accuracy(spark, d):
    """AGG8 / AGG17 over the generations table."""
    return G.exact_match_accuracy(_pred(spark, d))


MAJORITY_SQL = (
    "SELECT problem, answer, votes, samples, votes / samples AS agreement FROM ("
    "SELECT problem, answer, CAST(cnt AS BIGINT) AS votes, CAST(sum(cnt) OVER (PARTITION BY problem) AS BIGINT) AS samples, "
    "row_number() OVER (PARTITION BY problem ORDER BY cnt DESC, first_idx, answer) AS rk FROM ("
    "SELECT problem, answer, count(*) AS cnt, min(sample_idx) AS first_idx FROM votes GROUP BY problem, answer)) WHERE rk = 1"
)


@query("majority_vote", V.with_views(MAJORITY_SQL, "votes"))
def majority_vote(spark, d):
    """AGG11 over every problem of the votes table."""
    return G.majority_vote(V.votes(spark, d))


@query(
    "best_of_n",
    V.with_views(
        "SELECT problem, answer, score FROM (SELECT problem, answer, max(score) OVER (PARTITION BY problem) AS score, "
        "row_number() OVER (PARTITION BY problem ORDER BY score DESC, sample_idx, answer) AS rk FROM votes) WHERE rk = 1",
        "votes",
    ),
)
def best_of_n(spark, d):
    """AGG12: highest-scoring answer per problem."""
    return G.best_of_n(V.votes(spark, d))


@query("self_consistency", V.with_views(f"SELECT * FROM ({MAJORITY_SQL}) WHERE agreement >= 0.5", "votes"))
def self_consistency(spark, d):
    """AGG13: problems whose samples agree on at least half."""
    return G.self_consistency(V.votes(spark, d), 0.5)


@query(
    "reward_table",
    V.with_views(
        "SELECT conv_id, CAST(count(*) AS BIGINT) AS samples, avg(reward) AS mean_reward FROM ("
        f"SELECT g.conv_id, CASE WHEN {S.answers_equivalent('p.prediction', 'p.answer')} THEN 1.0 ELSE -1.0 END AS reward "
        "FROM predictions p JOIN generations g ON p.id = g.id WHERE p.answer IS NOT NULL) GROUP BY conv_id",
        "predictions",
    ),
)
def reward_table(spark, d):
    """AGG14: +1 / -1 per sample (format-tolerant), mean per problem."""
    g = V.generations(spark, d)
    r = G.rewards(G.predictions(g, keep=["conv_id"]).where(F.col("answer").isNotNull()))
    return r.groupBy("conv_id").agg(F.count(F.lit(1)).cast("bigint").alias("samples"), F.avg("reward").alias("mean_reward"))


@query(
    "error_classes",
    V.with_views(
        "SELECT error_class, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE "
        f"WHEN {S.raw_answer('prediction')} = {S.raw_answer('answer')} THEN 'correct' "
        f"WHEN {S.answers_equivalent('prediction', 'answer')} THEN 'format' "
        "WHEN contains(raw_generation, answer) THEN 'extraction' ELSE 'wrong' END AS error_class "
        "FROM predictions WHERE answer IS NOT NULL) GROUP BY error_class",
        "predictions",
    ),
)
def error_classes(spark, d):
    """AGG15: correct / format / extraction / wrong counts."""
    return G.error_classes(_pred(spark, d))


_EXACT = "CAST(q // gcd(q, 4) AS VARCHAR) || '/' || CAST(4 // gcd(q, 4) AS VARCHAR)"


@query("exact_answer_value", V.with_views(f"SELECT problem, sample_idx, answer, {_EXACT} AS value FROM answer_forms", "answer_forms"))
def exact_answer_value(spark, d):
    """PRJ17: exact reduced value of every answer, whatever form it is written in."""
    f = V.answer_forms(spark, d)
    return f.select("problem", "sample_idx", "answer", exact_value(F.col("answer")).alias("value"))


_MAJ_VALUE = (
    "SELECT problem, answer, votes, samples, votes / samples AS agreement FROM (SELECT problem, first.t AS answer, CAST(cnt AS BIGINT) AS votes, "
    "CAST(sum(cnt) OVER (PARTITION BY problem) AS BIGINT) AS samples, row_number() OVER (PARTITION BY problem ORDER BY cnt DESC, first) AS rk FROM ("
    "SELECT problem, q, count(*) AS cnt, min({'s': sample_idx, 't': answer}) AS first FROM answer_forms GROUP BY problem, q)) WHERE rk = 1"
)


@query("majority_vote_by_value", V.with_views(_MAJ_VALUE, "answer_forms"))
def majority_vote_by_value(spark, d):
    """AGG11 over classes of equal answers."""
    return G.majority_vote_by_value(V.answer_forms(spark, d))


@query("self_consistency_by_value", V.with_views(f"SELECT * FROM ({_MAJ_VALUE}) WHERE agreement >= 0.5", "answer_forms"))
def self_consistency_by_value(spark, d):
    """AGG13 over classes of equal answers."""
    return G.self_consistency(V.answer_forms(spark, d), 0.5, by_value=True)
