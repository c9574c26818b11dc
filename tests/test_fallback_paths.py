"""The shuffle-join paths taken when a model / key table is above its
broadcast bound give the same results as the broadcast paths."""

from pyspark.sql import functions as F

from quarry.operators import langid as L
from quarry.operators import sampling as SM
from quarry.sources.tables import table


def test_langid_without_broadcast(spark, sf, monkeypatch):
    doc = table(spark, sf, "documents").select("doc_id", "text", "lang")
    want = sorted(map(tuple, L.identify(doc).collect()))
    monkeypatch.setattr(L, "MAX_BROADCAST_MODEL_ROWS", 0)
    got = sorted(map(tuple, L.identify(doc).collect()))
    assert got == want
    acc = sum(1 for (i, p), r in zip(got, sorted(doc.select("doc_id", "lang").collect())) if p == r["lang"]) / len(got)
    assert acc > 0.9


def test_size_adjust_without_broadcast(spark, monkeypatch):
    df = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 5).cast("string").alias("g"))
    want = sorted(r["k"] for r in SM.size_adjust(df, 137, 3, "g", "k").collect())
    monkeypatch.setattr(SM, "MAX_BROADCAST_ROWS", 0)
    got = sorted(r["k"] for r in SM.size_adjust(df, 137, 3, "g", "k").collect())
    assert got == want and len(got) == 137
