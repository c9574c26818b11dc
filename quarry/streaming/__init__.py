"""Structured Streaming use of the stateless curation steps.

The reference has no streaming, state, watermarks or late data, so nothing
stateful is built here. The projection and filter operators are plain
column expressions, so they run unchanged on a streaming DataFrame; this
module only wires them for a file stream of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import curate as C


def curate_stream(stream: DataFrame, text: str = "text", budget_tokens: int = 8192, max_repetition: float = 0.30) -> DataFrame:
    """Row-local curation (FLT3 length budget + FLT8 repetition) on a stream."""
    s = C.token_length_filter(stream, text, budget_tokens)
    s = s.withColumn("_rep", C.repetition_struct(text))
    return s.where(F.col("_rep.rep_share") <= max_repetition).select(
        *stream.columns, T.word_count(text).alias("n_words"), F.col("_rep.rep_share").alias("rep_share")
    )
