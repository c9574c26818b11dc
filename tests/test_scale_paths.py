"""Quotas beyond the group limit, the bounded language fit, request kinds, and the evaluation set's sink."""

from pyspark.sql import functions as F

from quarry.operators import langid as L
from quarry.operators import synth as Y
from quarry.plans import jobs as J
from quarry.sources import csv as CSV


def _attempts(spark, n):
    """A hot category with nine tenths of the rows; every third attempt fails to parse."""
    i = F.col("id")
    text = F.when(i % 3 == 0, "nothing here").otherwise(F.concat(F.lit("PROMPT: p"), i.cast("string"), F.lit("\nANSWER: a"), i.cast("string")))
    return spark.range(n).select(((i * 7919) % n).alias("conv_id"), F.lit(0).alias("turn"), F.when(i % 10 == 0, "bit").otherwise("symbol").alias("category"), text.alias("text"))


def test_quota_matches_brute_force_beyond_the_group_limit(spark):
    df = _attempts(spark, 9000)
    rows = sorted(tuple(r) for r in df.collect())
    for count in (1000, 5000):
        want = set()
        for cat in ("bit", "symbol"):
            own = [t for _, _, c, t in rows if c == cat][: 3 * count]
            kept = [t for t in own if t.startswith("PROMPT")][:count]
            want |= {(f"syn_{cat[:3]}_{n:05d}", t.split("\n")[0][8:]) for n, t in enumerate(kept)}
        assert {(r["id"], r["prompt"]) for r in Y.quota_per_category(df, count).collect()} == want


def test_quota_attempt_factor(spark):
    df = _attempts(spark, 300).where("category = 'symbol'")
    few, more = (Y.quota_per_category(df, 50, attempts=k).count() for k in (1, 3))
    assert few < 50 and more == 50


def test_quota_ranks_salted_parts_first(spark):
    plan = Y.quota_per_category(_attempts(spark, 100), 5000)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(category" in plan and plan.count("_salt") > 1


def test_accepted_keeps_every_parsed_row(spark):
    df = _attempts(spark, 300).withColumn("id", F.col("conv_id"))
    got = Y.accepted(df)
    assert got.count() == 200 and got.select("id").distinct().count() == 200


def test_request_kinds(spark):
    counts = spark.createDataFrame([("physics", 3), ("unit", 0), ("numeral", None)], "category string, n bigint")
    got = Y.category_requests(counts).collect()
    assert sorted((r["category"], r["variant"]) for r in got) == [("physics", 1), ("physics", 2), ("physics", 3)]
    one = Y.trace_requests(spark.createDataFrame([("a", None), ("b", "2 + 2")], "id string, prompt string")).orderBy("seed_id").collect()
    assert one[0]["request"].endswith("Problem:\n") and one[1]["request"].endswith("2 + 2")


def test_eval_set_sink(spark, tmp_path):
    rows = spark.createDataFrame([("e0", "a\nb", "1", "physics"), ("e1", "c", None, "unit"), ("e2", "d", "2", "unit")], "id string, prompt string, answer string, category string")
    assert J.write_eval_set(rows, str(tmp_path / "e")) == {"physics": 1, "unit": 2}
    assert sorted(map(tuple, CSV.read_puzzles(spark, str(tmp_path / "e")).fillna("").collect())) == sorted((a, b, c or "", d) for a, b, c, d in map(tuple, rows.collect()))


EN = "the cat sat on the mat and looked at the house over there while it was raining"
DE = "der hund sitzt auf der matte und schaut auf das haus dort drüben weil es regnet"


def _texts(spark):
    return spark.createDataFrame([(i, EN if i % 2 else DE, "en" if i % 2 else "de") for i in range(400)], "doc_id bigint, text string, lang string")


def test_language_fit_is_bounded_and_held_out_rows_come_out_right(spark):
    docs = _texts(spark)
    n = docs.where(L.fit_draw() * 400 < 40).count()
    assert 10 < n < 90
    got = L.identify(docs, fit_rows=40, carry=["lang"])
    assert got.count() == 400 and got.where("predicted != lang").count() == 0


def test_rows_that_share_an_id_are_scored_one_by_one(spark):
    docs = spark.createDataFrame([(1, EN, "en"), (1, DE, "de"), (1, EN[::-1], None), (None, EN, None)], "doc_id bigint, text string, lang string")
    got = L.identify(docs, train=_texts(spark), carry=["lang"]).collect()
    assert len(got) == 4
    assert {(r["lang"], r["predicted"]) for r in got if r["lang"]} == {("en", "en"), ("de", "de")}


def test_curated_ids_alone_are_written(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = J.curate_corpus(docs, 20)
    assert got.columns == docs.columns and got.count() == 20
    assert sum("text" in x for x in got._jdf.queryExecution().optimizedPlan().collectLeaves().toString().split("LogicalRDD")[1:]) == 0


def test_compressed_files_are_grouped_by_header(spark, tmp_path):
    import gzip

    for i in range(3):
        with gzip.open(tmp_path / f"a {i}.csv.gz", "wt", newline="") as f:
            f.write(f'id,prompt,answer\r\nx{i},"two\r\nlines",1\r\n')
    (tmp_path / "b.csv").write_text("﻿prompt,id,note\np,y,n\n")
    got = CSV.read_puzzle_glob(spark, str(tmp_path / "*.csv*"))
    rows = {r["id"]: (r["prompt"], r["answer"], r["note"]) for r in got.collect()}
    assert rows == {"x0": ("two\r\nlines", "1", None), "x1": ("two\r\nlines", "1", None), "x2": ("two\r\nlines", "1", None), "y": ("p", None, "n")}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2


def test_spread_stays_off_a_cluster(spark, sf, monkeypatch):
    from quarry.sources import tables

    assert "Repartition" not in spark.read.parquet(f"{sf}/documents.parquet")._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
    df = tables.spread(spark.read.parquet(f"{sf}/documents.parquet"))
    assert "Repartition" not in df._jdf.queryExecution().optimizedPlan().toString()
