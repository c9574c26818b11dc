"""The corpus pipeline: five stages over whole documents, each written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of ``documents``; the last adds each row's shard and slot.

Language ID lets documents go whose language cannot be told (no letters, or a
posterior below one half). Near duplicates keep one document per component.
Decontamination drops documents with a verified benchmark window. Mixing writes
a document as often as the mix takes it. Sharding assigns every row of the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontaminate, langid_pieces, mixing, sharding, simhash
from quarry.llm.common import read, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid_pieces.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.with_shards(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("source_mix", source_mix), ("shards", shards)]

# Language ID and SimHash components have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}", compression="snappy")
    return docs
