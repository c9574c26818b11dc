"""Driver tables: one Parquet file per table under a scale-factor folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Tables whose rows drive heavy row-local work here (long texts, puzzle
# generation). Numeric tables are aggregated with map-side partial
# aggregation, where one split per core is already the cheapest plan.
ROW_HEAVY = {"documents", "conversations", "pages", "part"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst prunes columns and pushes filters into it.

    In a local session (tests, bench) a text-heavy scan that yields fewer splits
    than there are cores (a small table stored as one row group) is spread
    round-robin so row-local work (regexes, higher-order functions, generators)
    uses every core. On a cluster scans are left as they are."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df) if name in ROW_HEAVY else df


def spread(df: DataFrame) -> DataFrame:
    try:
        if not df.sparkSession.sparkContext.master.startswith("local["):
            return df
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (e.g. a remote session): leave the scan as it is
        return df
    return df.repartition(cores) if splits < cores else df


# Seed rows of one task of a generator: some seconds of work.
ROWS_PER_TASK = 20_000


def dealt(df: DataFrame, rows: int = ROWS_PER_TASK) -> DataFrame:
    """Narrow rows dealt round-robin, on any session: at most about ``rows`` to a part, and a
    part for every core. A generator makes much text from each key, and a scan of a few
    megabytes of keys is one split however many rows it has. The count reads footers only."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // rows)))
