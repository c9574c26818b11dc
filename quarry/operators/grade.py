"""Grading: predictions, exact-match accuracy, voting, rewards, error classes.

Voting keys are (problem, answer) and then problem; both aggregates are
partially aggregated before the shuffle (``min_by`` included), so a problem
holding a large share of all samples never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.exact import exact_value


def predictions(
    gen: DataFrame, id_col: str = "id", generation: str = "raw_generation", answer: str = "answer", keep=()
) -> DataFrame:
    """DM3 prediction records: extracted prediction plus raw / normalised
    exact-match flags when a gold answer exists (null otherwise)."""
    pred = T.extract_final_answer(generation)
    has = F.col(answer).isNotNull()
    return gen.select(
        *keep,
        F.col(id_col).alias("id"),
        pred.alias("prediction"),
        F.col(generation).alias("raw_generation"),
        F.col(answer).alias("answer"),
    ).select(
        *keep,
        "id",
        "prediction",
        "raw_generation",
        "answer",
        F.when(has, T.raw_answer("prediction") == T.raw_answer("answer")).alias("raw_exact"),
        F.when(has, T.normalize_answer("prediction") == T.normalize_answer("answer")).alias("normalized_exact"),
    )


def prediction_table(pred: DataFrame) -> DataFrame:
    """Rows as the prediction CSV holds them: booleans as True/False, the three
    answer columns blank on rows without an answer."""

    def flag(c):
        return F.when(F.col("answer").isNotNull(), F.initcap(F.col(c).cast("string"))).otherwise(F.lit(""))

    return pred.select(
        "id",
        "prediction",
        "raw_generation",
        F.coalesce(F.col("answer"), F.lit("")).alias("answer"),
        flag("raw_exact").alias("raw_exact"),
        flag("normalized_exact").alias("normalized_exact"),
    )


def exact_match_accuracy(pred: DataFrame) -> DataFrame:
    """AGG8 / AGG17: accuracy over answered rows; no row when none is answered."""
    answered = pred.where(F.col("answer").isNotNull())
    return (
        answered.agg(
            F.count(F.lit(1)).cast("bigint").alias("num_rows"),
            F.avg(F.col("raw_exact").cast("int")).alias("raw_exact_accuracy"),
            F.avg(F.col("normalized_exact").cast("int")).alias("normalized_exact_accuracy"),
        ).where(F.col("num_rows") > 0)
    )


def _answer_counts(votes: DataFrame, problem: str, sample: str, answer: str) -> DataFrame:
    return votes.groupBy(problem, answer).agg(F.count(F.lit(1)).alias("cnt"), F.min(sample).alias("first_idx"))


def majority_vote(votes: DataFrame, problem: str = "problem", sample: str = "sample_idx", answer: str = "answer") -> DataFrame:
    """AGG11 maj@N: most frequent answer per problem; ties go to the answer
    seen first (smallest sample index), then to the smaller answer."""
    ac = _answer_counts(votes, problem, sample, answer)
    order_key = F.struct((-F.col("cnt")).alias("neg_cnt"), F.col("first_idx"), F.col(answer))
    return ac.groupBy(problem).agg(
        F.min_by(F.col(answer), order_key).alias("answer"),
        F.max("cnt").cast("bigint").alias("votes"),
        F.sum("cnt").cast("bigint").alias("samples"),
    ).select(problem, "answer", "votes", "samples", (F.col("votes") / F.col("samples")).alias("agreement"))


def majority_vote_by_value(votes: DataFrame, problem: str = "problem", sample: str = "sample_idx", answer: str = "answer") -> DataFrame:
    """AGG11 over classes of equal answers: ``3/4``, ``0.75`` and ``\\frac{3}{4}`` vote
    together. A class is an exact value, or else a canonical text (null is a class of its
    own); its first answer (smallest sample index, then smaller text) stands for it. Ties
    go to the class seen first. Both aggregates combine before the shuffle."""
    text = T.canonical_text(answer)
    kind = F.when(F.col(answer).isNotNull(), F.coalesce(F.concat(F.lit("="), exact_value(text)), F.concat(F.lit(":"), text)))
    seen = F.struct(F.col(sample).alias("at"), F.col(answer).alias("text"))
    classes = votes.select(F.col(problem).alias("problem"), kind.alias("kind"), seen.alias("seen")).groupBy("problem", "kind").agg(F.count(F.lit(1)).alias("cnt"), F.min("seen").alias("first"))
    order_key = F.struct((-F.col("cnt")).alias("neg_cnt"), F.col("first"), F.col("kind"))
    best = classes.groupBy("problem").agg(F.min_by("first", order_key).alias("first"), F.max("cnt").cast("bigint").alias("votes"), F.sum("cnt").cast("bigint").alias("samples"))
    return best.select(F.col("problem").alias(problem), F.col("first.text").alias(answer), "votes", "samples", (F.col("votes") / F.col("samples")).alias("agreement"))


def best_of_n(votes: DataFrame, problem: str = "problem", sample: str = "sample_idx", answer: str = "answer", score: str = "score") -> DataFrame:
    """AGG12: answer with the highest score; ties to the smaller sample index, then
    answer. Null and NaN scores do not vote; a problem with no other keeps a null answer."""
    s = F.col(score).cast("double")
    scored = F.col(score).isNotNull() & ~F.isnan(s)
    order_key = F.when(scored, F.struct((-F.col(score)).alias("neg_score"), F.col(sample), F.col(answer)))
    return votes.groupBy(problem).agg(
        F.min_by(F.col(answer), order_key).alias("answer"),
        F.max(F.when(scored, F.col(score))).alias("score"),
    )


def self_consistency(votes: DataFrame, threshold: float = 0.5, by_value: bool = False, **kw) -> DataFrame:
    """AGG13: problems whose majority answer (``by_value``: class of equal answers) has at
    least ``threshold`` of the samples."""
    vote = majority_vote_by_value if by_value else majority_vote
    return vote(votes, **kw).where(F.col("agreement") >= threshold)


def rewards(pred: DataFrame, prediction: str = "prediction", answer: str = "answer", correct: float = 1.0, wrong: float = -1.0) -> DataFrame:
    """AGG14: format-tolerant reward per sample."""
    ok = T.answers_equivalent(prediction, answer)
    return pred.withColumn("reward", F.when(ok, F.lit(correct)).otherwise(F.lit(wrong)))


def error_class(prediction: str = "prediction", answer: str = "answer", generation: str = "raw_generation"):
    """AGG15 classes: correct / format (equal after canonicalisation) /
    extraction (the generation contains the answer) / wrong."""
    raw_eq = T.raw_answer(prediction) == T.raw_answer(answer)
    return (
        F.when(raw_eq, F.lit("correct"))
        .when(T.answers_equivalent(prediction, answer), F.lit("format"))
        .when(F.col(generation).contains(F.col(answer)), F.lit("extraction"))
        .otherwise(F.lit("wrong"))
    )


def error_classes(pred: DataFrame) -> DataFrame:
    answered = pred.where(F.col("answer").isNotNull())
    return answered.groupBy(error_class().alias("error_class")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
