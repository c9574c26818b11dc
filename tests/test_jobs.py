"""End-to-end jobs: prepare (JOB1), grade (JOB2), check and augment (JOB6)."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from quarry.plans import jobs as J
from quarry.plans import views as V


def test_prepare_training_data(spark, sf):
    d = tempfile.mkdtemp(prefix="quarry-job-")
    src = os.path.join(d, "train_csv")
    from quarry.sources import csv as CSV

    CSV.write_puzzles(V.pairs(spark, sf).select("id", "prompt", "answer"), src)
    meta = J.prepare_training_data(spark, src, os.path.join(d, "out"), sample_size=30, valid_size=0.2, seed=7)
    assert meta["num_sampled_rows"] == min(30, meta["num_total_rows"])
    assert meta["num_valid_rows"] == round(meta["num_sampled_rows"] * 0.2)
    assert meta["num_train_rows"] + meta["num_valid_rows"] == meta["num_sampled_rows"]
    texts = spark.read.json(os.path.join(d, "out", "train_text")).collect()
    assert len(texts) == meta["num_train_rows"] and all(t["text"].startswith("<|im_start|>user\n") for t in texts)
    md = spark.read.json(os.path.join(d, "out", "run_metadata")).first()
    assert md["num_total_rows"] == meta["num_total_rows"]


def test_grade_generations(spark, sf):
    d = tempfile.mkdtemp(prefix="quarry-job-")
    m = J.grade_generations(V.generations(spark, sf), d).first()
    g = V.generations(spark, sf)
    assert m["num_rows"] == g.count()
    from quarry.sources import csv as CSV

    pred = CSV.read_csv(spark, os.path.join(d, "predictions"))
    assert set(pred.columns) == {"id", "prediction", "raw_generation", "answer", "raw_exact", "normalized_exact"}
    assert {r[0] for r in pred.select("raw_exact").distinct().collect()} <= {"True", "False"}
    assert pred.count() == g.count()


def test_check_and_augment(spark, sf):
    d = tempfile.mkdtemp(prefix="quarry-job-")
    with open(os.path.join(d, "synthetic_bit.csv"), "w") as f:
        f.write('id,prompt,answer,category\nsyn_bit_00000,"x\n00000001 -> 00000010\n00000011 -> 00000110\n'
                '10000000 -> 00000001\nNow, determine the output for: 00000100",00001000,bit_manipulation\n')
    with open(os.path.join(d, "synthetic_txt.csv"), "w") as f:
        f.write("id,prompt,answer\nsyn_tex_00000,p,\n")
    orig = V.examples(spark, sf).select("id", "prompt", "answer")
    rep = J.check_and_augment(spark, orig, os.path.join(d, "synthetic_*.csv"), os.path.join(d, "combined"))
    assert rep["rows"] == 2 and rep["answer_nulls"] == 1 and rep["duplicate_ids"] == 0 and rep["rule_failures"] == 0
    combined = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(os.path.join(d, "combined"))
    assert combined.count() == orig.count() + 2
    assert combined.where(F.col("category") == "bit_manipulation").count() == 1
