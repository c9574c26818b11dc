"""User-level jobs composed from the operators.

Each job is one lazy plan from scan to sink; the only actions are the writes
and the single-row counts that the reference reports. Outputs go to the
folder the caller names (shared storage on a cluster).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import curate as C
from quarry.operators import grade as G
from quarry.operators import langid as L
from quarry.operators import profile as P
from quarry.operators import sampling as SM
from quarry.operators import tokenizer as TK
from quarry.operators import validate as VA
from quarry.session import materialize
from quarry.sources import csv as CSV
from quarry.sources.scratch import written


def training_split_text(rows: DataFrame, sample_size: int, valid_size: float, seed: int) -> DataFrame:
    """JOB1 core: SMP1 -> SMP2 -> PRJ9; columns id, prompt, answer, split, text.
    Only training rows are rendered, so only they need an answer."""
    sampled = materialize(SM.sample_exact(rows, sample_size, seed, "id"))
    split = SM.train_valid_split(sampled, valid_size, seed, "id")
    return split.withColumn("text", F.when(F.col("split") == "train", T.render_training_text("prompt", "answer")))


def prepare_training_data(spark: SparkSession, csv_path: str, out_dir: str, sample_size: int = 0, valid_size: float = 0.0, seed: int = 42) -> dict:
    """JOB1: scan the puzzle CSV once into Parquet, sample, split, write one CSV
    folder per split, the training-text JSON lines and the run metadata."""
    staged = f"{out_dir}/staged.parquet"
    CSV.read_puzzles(spark, csv_path).write.mode("overwrite").parquet(staged)
    rows = spark.read.parquet(staged)
    total = rows.count()
    split_path = f"{out_dir}/split.parquet"
    training_split_text(rows, sample_size, valid_size, seed).write.mode("overwrite").parquet(split_path)
    out = spark.read.parquet(split_path)
    counts = out.agg(
        F.count(F.lit(1)).alias("num_sampled_rows"),
        F.count_if(F.col("split") == "train").alias("num_train_rows"),
        F.count_if(F.col("split") == "valid").alias("num_valid_rows"),
    ).first()
    for part in ("train", "valid"):  # id, prompt and, where any row has one, answer; no folder for an empty split
        if counts[f"num_{part}_rows"]:
            CSV.write_puzzles(out.where(F.col("split") == part), f"{out_dir}/splits/{part}")
    CSV.write_training_text(out.where(F.col("split") == "train"), f"{out_dir}/train_text")
    meta = {"csv_path": csv_path, "sample_size": sample_size, "valid_size": valid_size, "seed": seed, "num_total_rows": total, **counts.asDict()}
    CSV.write_json_artifact(spark.createDataFrame([meta]), f"{out_dir}/run_metadata")
    return meta


def grade_generations(generations: DataFrame, out_dir: str) -> DataFrame:
    """JOB2: predictions CSV, the metrics row (absent when nothing is answered) and
    the error classes of the answered rows; extraction runs once."""
    pred = materialize(G.predictions(generations))
    CSV.write_predictions(G.prediction_table(pred), f"{out_dir}/predictions")
    metrics = G.exact_match_accuracy(pred)
    if metrics.take(1):
        CSV.write_json_artifact(metrics, f"{out_dir}/eval_metrics")
        G.error_classes(pred).write.mode("overwrite").json(f"{out_dir}/error_classes")
    return metrics


def curate_corpus(
    docs: DataFrame,
    size: int,
    seed: int = 42,
    categories: Sequence[str] | None = None,
    category_col: str = "lang",
    budget_tokens: int = 8192,
    max_repetition: float = 0.30,
    language: str = "en",
    stratum: str = "source",
    train: DataFrame | None = None,
    id_col: str = "doc_id",
) -> DataFrame:
    """JOB5: FLT7 category -> FLT3 length budget -> FLT8 repetition -> FLT9
    language -> SMP7 size adjustment (proportional per ``stratum``). The
    language model is fitted on ``train`` (default: the labelled rows of ``docs``).

    One pass over the texts filters and scores; the rows that remain are written
    once with a number each. The sizes are adjusted on (number, id, stratum), and
    the chosen numbers go back to the written rows: rows that share an id or have
    none are judged each on its own, and no more than ``size`` rows come out."""
    rows = docs if categories is None else C.category_filter(docs, category_col, categories)
    rows = C.token_length_filter(rows, "text", budget_tokens)
    rows = C.repetition_filter(rows, "text", max_repetition)
    rows = L.language_filter(rows, language, train=train if train is not None else docs, id_col=id_col)
    kept = written(rows.withColumn("_row", F.monotonically_increasing_id()), "curated")
    # the exact-size selection reads its input several times (histogram, boundary, final filter)
    chosen = SM.size_adjust(kept.select("_row", id_col, stratum), size, seed, stratum, id_col).select("_row")
    few = F.broadcast(chosen) if size <= SM.MAX_BROADCAST_ROWS else chosen
    return kept.join(few, "_row", "left_semi").select(*docs.columns)


def write_eval_set(rows: DataFrame, out_path: str) -> dict[str, int]:
    """JOB3 sink: the evaluation set as puzzle CSV (SNK5, with its category) and
    the rows per category (AGG9, one row per category on the driver)."""
    CSV.write_puzzles(rows, out_path, extra=["category"])
    counts = rows.groupBy("category").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["category"]: r["n"] for r in counts}


def filter_traces(traces: DataFrame, batches: DataFrame | None = None, min_words: int = 20, max_words: int = 6000, max_repetition: float = 0.30, max_defect: float = 0.10, id_col: str = "doc_id", votes: DataFrame | None = None, min_agreement: float = 0.5) -> DataFrame:
    """JOB7: PRJ7 -> FLT11 answer tag -> FLT10 trace length -> FLT8 repetition
    of the trace -> FLT12 batch rejection (when a batch table is given) -> AGG13
    (when votes are given: traces of problems whose samples agree)."""
    t = C.trace_filter(traces, "response", min_words, max_words)
    t = C.repetition_filter(t, "trace", max_repetition)
    if batches is not None:
        bad = C.rejected_batches(batches, max_rate=max_defect)
        t = t.join(batches.select(id_col, "batch"), id_col, "left")
        t = t.join(bad, t["batch"].eqNullSafe(bad["_bad_batch"]), "left_anti")
    if votes is not None:
        agreed = G.self_consistency(votes, min_agreement).select(F.col("problem").alias("_agreed"))
        t = t.join(agreed, t[id_col] == agreed["_agreed"], "left_semi")
    return t


def profile_dataset(df: DataFrame, prompt: str = "prompt", answer: str = "answer", bins: int = 50, max_short: int = 10, vocab_sizes: Sequence[int] = ()) -> dict[str, DataFrame]:
    """JOB4: lengths, words and token estimates described, the histogram and density
    of the total length and of the token estimate, the most frequent words, and the
    degenerate rows, all from one written copy of the narrow measures. With
    ``vocab_sizes`` also AGG10: vocabularies of these sizes fitted on both texts, and
    the tokens that the prompts take in each."""
    cols = P.token_columns(P.word_columns(P.length_columns(df, prompt, answer), prompt, answer), prompt, answer)
    lengths, words = ["len_prompt", "len_answer", "total_len"], ["words_prompt", "words_answer", "total_words"]
    keep = [c for c in df.columns if c not in (prompt, answer)]
    m = materialize(cols.select(*keep, *lengths, *words, "token_estimate"))
    sweep = {"vocabulary": TK.vocabulary_sweep(df, tuple(vocab_sizes), (prompt, answer), prompt)} if vocab_sizes else {}
    return sweep | {
        "lengths": P.describe(m, lengths),
        "words": P.describe(m, words),
        "tokens": P.describe(m, ["token_estimate"]),
        "length_histogram": P.histogram(m, "total_len", bins),
        "length_density": P.density_curve(m, "total_len"),
        "token_histogram": P.histogram(m, "token_estimate", bins),
        "token_density": P.density_curve(m, "token_estimate"),
        "top_words": P.top_words(df, (prompt, answer)),
        "short_rows": P.short_rows(m, max_len=max_short),
    }


def check_and_augment(spark: SparkSession, original: DataFrame, synthetic_glob: str, out_path: str) -> dict:
    """JOB6: read every synthetic CSV, report nulls / blank answers / rule
    failures / duplicate ids, and write the union of original and synthetic rows."""
    syn = materialize(CSV.read_puzzle_glob(spark, synthetic_glob))
    combined = original.unionByName(syn, allowMissingColumns=True)
    judged = VA.validation_columns(syn) if "category" in syn.columns else syn
    rules = [c for c in judged.columns if c.startswith("v") and c[1:2].isdigit()] if "category" in syn.columns else []
    report = judged.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("prompt").isNull()).alias("prompt_nulls"),
        F.count_if(F.col("answer").isNull()).alias("answer_nulls"),
        F.count_if(T.strip("answer") == "").alias("blank_answers"),
        *[F.count_if(~F.col(c)).alias(f"{c}_failures") for c in rules],  # null results are no failures
    ).first().asDict()
    if rules:
        report["rule_failures"] = report["v8_consistent_failures"]
    report["duplicate_ids"] = VA.duplicate_ids(combined.select("id")).count()
    extra = ["category"] if "category" in combined.columns else []
    CSV.write_puzzles(combined, out_path, extra=extra)
    return report
