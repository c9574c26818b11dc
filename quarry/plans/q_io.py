"""Source / sink queries: CSV round trip and the plain-text corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans import views as V
import quarry.plans.q_grade  # noqa: F401  (registers prediction_table first)
from quarry.plans.registry import ORACLES, query
from quarry.sources import csv as CSV
from quarry.sources.scratch import scratch_path


@query("csv_roundtrip", V.with_views("SELECT id, prompt, answer FROM examples", "examples"))
def csv_roundtrip(spark, d):
    """SNK1 then SRC1: every example written as puzzle CSV and read back by header name."""
    path = scratch_path(spark, "csv")
    CSV.write_puzzles(V.examples(spark, d).select("id", "prompt", "answer"), path)
    return CSV.read_puzzles(spark, path)


@query(
    "corpus_lines",
    V.with_views("SELECT unnest(string_split(concat_ws(' ', prompt, answer), chr(10))) AS value FROM examples", "examples"),
)
def corpus_lines(spark, d):
    """SNK6: the text corpus written and read back line by line."""
    path = scratch_path(spark, "corpus")
    CSV.write_corpus(V.examples(spark, d), path)
    return spark.read.text(path)


@query("prediction_csv", ORACLES.get("prediction_table"))
def prediction_csv(spark, d):
    """SNK2 then SRC2: the prediction CSV written and read back (all STRING)."""
    from quarry.operators import grade as G

    path = scratch_path(spark, "pred")
    CSV.write_predictions(G.prediction_table(G.predictions(V.generations(spark, d))), path)
    return CSV.read_csv(spark, path).select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("id", "prediction", "raw_generation", "answer", "raw_exact", "normalized_exact")])
