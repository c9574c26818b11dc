"""Cases in which rows or values were once lost or altered."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.functions import numbers as N
from quarry.functions import text as T
from quarry.operators import curate as C
from quarry.operators import grade as G
from quarry.operators import profile as P
from quarry.operators import sampling as SM
from quarry.operators import validate as VA
from quarry.plans import jobs as J
from quarry.sources import csv as CSV


def test_null_stratum_gets_its_rows(spark):
    df = spark.range(100).select(F.col("id"), F.when(F.col("id") % 4 != 0, (F.col("id") % 3).cast("string")).alias("s"))
    out = SM.size_adjust(df, 40, 1, "s")
    assert out.count() == 40 and out.where("s is null").count() == 10


@pytest.mark.parametrize("k", [5, 15, 33, 100])
def test_exactly_k_with_repeated_ids(spark, k):
    df = spark.range(100).select((F.col("id") % 10).alias("id"), F.col("id").alias("row"))
    out = SM.sample_exact(df, k, 3)
    assert out.count() == k and out.select("row").distinct().count() == k
    sp = SM.train_valid_split(df, 0.33, 3)
    assert sp.count() == 100 and sp.where("split = 'valid'").count() == 33


def test_stratified_sample_of_a_large_category(spark):
    df = spark.range(20000).select(F.col("id"), F.when(F.col("id") < 18000, "hot").otherwise("cold").alias("c"))
    out = SM.stratified_sample(df, "c", 5000, 1).groupBy("c").count().collect()
    assert {r["c"]: r["count"] for r in out} == {"hot": 5000, "cold": 2000}


def test_describe_keeps_fractions_and_skips_nulls(spark):
    d = P.describe(spark.createDataFrame([(2.75,), (2.25,), (0.5,), (None,)], "v double"), ["v"], decimals=4).first()
    assert (d["count"], d["mean"], d["min"], d["max"], d["p50"]) == (3, 1.8333, 0.5, 2.75, 2.25)
    d = P.describe(spark.createDataFrame([(1,), (None,), (3,)], "v bigint"), ["v"]).first()
    assert (d["count"], d["mean"]) == (2, 2.0)


def test_density_of_equal_values_is_no_curve(spark):
    for n in (1, 5):
        assert P.density_curve(spark.range(n).select(F.lit(2.0).alias("v")), "v").count() == 0


def test_roman_numerals_without_limit(spark):
    df = spark.createDataFrame([(-5,), (0,), (4,), (3999,), (4000,), (12345,)], "n bigint")
    assert [r[0] for r in df.select(N.int_to_roman("n")).collect()] == ["", "", "IV", "MMMCMXCIX", "MMMM", "M" * 12 + "CCCXLV"]


def test_equality_is_one_notion(spark):
    df = spark.createDataFrame([("１２", "12", "１２"), ("1/2", "\\frac{1}{2}", "1/2"), ("3", "4", "3"), ("x", "y", "y?")], "prediction string, answer string, raw_generation string")
    assert [r[0] for r in G.rewards(df).select("reward").collect()] == [1.0, 1.0, -1.0, -1.0]
    assert [r[0] for r in df.select(G.error_class()).collect()] == ["format", "format", "wrong", "extraction"]
    assert df.select(T.canonical_value(F.lit("9" * 400 + "/0"))).count() == 4


def test_null_scores_do_not_win(spark):
    v = spark.createDataFrame([(1, 0, "a", 0.9), (1, 1, "b", None), (1, 2, "c", 0.3), (2, 0, "z", None), (3, 0, "n", float("nan")), (3, 1, "m", 0.1)], "problem int, sample_idx int, answer string, score double")
    got = {r["problem"]: (r["answer"], r["score"]) for r in G.best_of_n(v).collect()}
    assert got == {1: ("a", 0.9), 2: (None, None), 3: ("m", 0.1)}


@pytest.mark.parametrize("fn", [lambda x: x & 0b10101010, lambda x: x | 0b00001111, lambda x: x ^ 0b01011010, lambda x: ~x & 255])
def test_mask_puzzles_are_consistent(spark, fn):
    lines = "\n".join(f"{x:08b} -> {fn(x):08b}" for x in (3, 129, 90, 255))
    q = f"x\n{lines}\nNow, determine the output for: {37:08b}"
    df = spark.createDataFrame([("a", q, f"{fn(37):08b}", "bit_manipulation"), ("b", q, f"{fn(37) ^ 1:08b}", "bit_manipulation")], "id string, prompt string, answer string, category string")
    got = {r["id"]: r["v8_consistent"] for r in VA.validation_columns(df).collect()}
    assert got["a"] is True
    assert not got["b"]


def test_unrated_documents_stay_with_their_batch(spark):
    b = spark.createDataFrame([(1, "a", 0), (2, "a", None), (3, "b", 1), (4, "b", None), (5, "c", None)], "doc_id int, batch string, defect int")
    assert sorted(r["doc_id"] for r in C.batch_rejection(b).collect()) == [1, 2, 5]


def test_json_artifact_holds_one_row_and_null_keys(spark):
    d = tempfile.mkdtemp(prefix="quarry-json-")
    with pytest.raises(ValueError):
        CSV.write_json_artifact(spark.range(2), d + "/two")
    with pytest.raises(ValueError):
        CSV.write_json_artifact(spark.range(0), d + "/none")
    CSV.write_json_artifact(spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b"), d + "/one")
    text = "".join(r[0] for r in spark.read.text(d + "/one").collect())
    assert '"b":null' in text


def test_line_ends_in_fields_stay(spark):
    d = tempfile.mkdtemp(prefix="quarry-crlf-")
    for name, end in (("crlf", "\r\n"), ("lf", "\n")):
        path = os.path.join(d, f"{name}.csv")
        with open(path, "w", newline="") as f:
            f.write(end.join(["id,prompt,answer", '1,"a\r\nb",x', '2,"c\nd","y\r\nz"', "3,e,", ""]))
        got = [tuple(r) for r in CSV.read_puzzles(spark, path).collect()]
        assert got == [("1", "a\r\nb", "x"), ("2", "c\nd", "y\r\nz"), ("3", "e", None)]


def test_splits_have_the_input_columns_and_valid_rows_need_no_answer(spark):
    d = tempfile.mkdtemp(prefix="quarry-split-")
    rows = [(f"r{i}", f"p{i}", f"a{i}") for i in range(20)]
    full = spark.createDataFrame(rows, "id string, prompt string, answer string")
    valid = {r["id"] for r in SM.train_valid_split(full, 0.2, 7).where("split = 'valid'").collect()}
    CSV.write_puzzles(full.withColumn("answer", F.when(~F.col("id").isin(min(valid)), F.col("answer"))), d + "/src")
    meta = J.prepare_training_data(spark, d + "/src", d + "/out", valid_size=0.2, seed=7)
    assert (meta["num_train_rows"], meta["num_valid_rows"]) == (16, 4)
    got = CSV.read_csv(spark, d + "/out/splits/valid")
    assert got.columns == ["id", "prompt", "answer"] and {r["id"] for r in got.collect()} == valid


def test_profile_job(spark):
    df = spark.createDataFrame([("a b", "c"), ("longer text here", "yes"), ("x", None)], "prompt string, answer string")
    out = J.profile_dataset(df, max_short=4)
    assert out["tokens"].first()["mean"] == 2.0
    assert sum(r["count"] for r in out["token_histogram"].collect()) == 3 == sum(r["count"] for r in out["length_histogram"].collect())
    assert out["short_rows"].count() == 2 and out["lengths"].count() == 3 and out["top_words"].count() > 0 and out["token_density"].count() == 200


def test_traces_of_agreeing_problems(spark):
    words = " ".join(f"w{i}" for i in range(40))
    t = spark.createDataFrame([(i, f"<think>{words}</think><answer>a</answer>") for i in (1, 2)], "doc_id int, response string")
    votes = spark.createDataFrame([(1, 0, "a"), (1, 1, "a"), (2, 0, "a"), (2, 1, "b"), (2, 2, "c")], "problem int, sample_idx int, answer string")
    assert [r["doc_id"] for r in J.filter_traces(t, votes=votes).collect()] == [1]
