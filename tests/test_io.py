"""CSV round trip with hostile fields; SRC3 glob with differing headers."""

import os
import tempfile

from quarry.sources import csv as CSV

ROWS = [
    ("1", 'line one\nline "two"\\ end', "  a  "),
    ("2", '"', None),
    ("3", "\\", "NA"),
    ("4", "\\'*'> = ![@", "0110110"),
    ("5", " lead and trail ", "154.60"),
]


def test_csv_round_trip_is_identity(spark):
    d = tempfile.mkdtemp(prefix="quarry-test-")
    df = spark.createDataFrame(ROWS, "id string, prompt string, answer string")
    assert CSV.write_puzzles(df, os.path.join(d, "out"))
    back = CSV.read_puzzles(spark, os.path.join(d, "out"))
    assert sorted(map(tuple, back.collect())) == sorted(ROWS)


def test_no_answer_column_when_all_null(spark):
    d = tempfile.mkdtemp(prefix="quarry-test-")
    df = spark.createDataFrame([("1", "p", None)], "id string, prompt string, answer string")
    assert not CSV.write_puzzles(df, os.path.join(d, "out"))
    assert CSV.read_csv(spark, os.path.join(d, "out")).columns == ["id", "prompt"]


def test_glob_with_different_headers(spark):
    d = tempfile.mkdtemp(prefix="quarry-test-")
    with open(os.path.join(d, "synthetic_a.csv"), "w") as f:
        f.write("id,prompt,answer\nx1,p1,a1\n")
    with open(os.path.join(d, "synthetic_b.csv"), "w") as f:
        f.write("prompt,id,category\np2,x2,bit\n")
    got = {r["id"]: r for r in CSV.read_puzzle_glob(spark, os.path.join(d, "synthetic_*.csv")).collect()}
    assert got["x1"]["answer"] == "a1" and got["x1"]["category"] is None
    assert got["x2"]["prompt"] == "p2" and got["x2"]["category"] == "bit" and got["x2"]["answer"] is None
