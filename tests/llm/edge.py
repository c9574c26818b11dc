"""A small documents table with every awkward row, shared by the operator tests."""

from pyspark.sql import functions as F

LONG = "alpha beta gamma delta " * 5000

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away home today", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs away home today", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs away home today", "en", "a"),  # a repeated row
    (3, None, None, None),
    (4, "", "en", None),
    (5, " \t\n ", "fr", "b"),
    (6, LONG, "de", "b"),
    (7, "ÀÉ straße №1 日本語 テキスト", None, "c"),
    (8, "12 34 !!", "es", "c"),
    (None, "a document without an id", "en", "a"),
    (9, "x", "en", "a"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


def documents(spark, rows=ROWS, clash=True):
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:  # extra columns whose names operators use for their own results
        for c in ("size", "shard", "slot", "rate", "target", "digest", "gram", "items", "spans", "g", "fp", "n", "host", "path", "rule", "score", "h", "w"):
            df = df.withColumn(c, F.lit("kept"))
    return df


def rows_of(df):
    return [r.asDict() for r in df.collect()]
