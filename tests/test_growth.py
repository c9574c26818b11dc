"""Steps that grow with the input: seeds are dealt on any session, draws are ranked by the
built-in order, fits are made once a row, sinks and globs look at no more than they need."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.lattice import Lattice, Trie
from quarry.operators import synth as Y
from quarry.operators import tokenizer as TK
from quarry.operators import validate as VA
from quarry.plans import q_synth as QS
from quarry.sources import csv as CSV
from quarry.sources import tables


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """A part table in one file with one row group; a null and a repeated key."""
    d = tmp_path_factory.mktemp("parts")
    keys = spark.range(50_000).select(F.when(F.col("id") == 7, None).when(F.col("id") == 8, F.lit(9)).otherwise(F.col("id")).alias("p_partkey"))
    keys.coalesce(1).write.parquet(str(d / "part.parquet"))
    return str(d)


def test_seeds_are_dealt_on_a_cluster_too(spark, parts, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
    for fn in (QS.synth_physics, QS.synth_unit_conversion, QS.synth_numeral, QS.puzzles):
        assert "Repartition" in _plan(fn(spark, parts)), fn.__name__
    seeds = spark.read.parquet(f"{parts}/part.parquet")
    assert seeds.rdd.getNumPartitions() == 1
    assert tables.dealt(seeds).rdd.getNumPartitions() == max(3, spark.sparkContext.defaultParallelism)
    few = tables.dealt(seeds, 5_000)
    assert few.rdd.getNumPartitions() == 10 and max(few.rdd.glom().map(len).collect()) <= 5_100
    assert few.exceptAll(seeds).isEmpty() and few.count() == 50_000


def test_numerals_are_the_first_of_the_ranking(spark):
    keys = [0, 1, 1, 77, 123456789, None]
    got = Y.numeral_system(spark.createDataFrame([(k,) for k in keys], "key bigint"), "key")
    assert "array_sort" not in _plan(got)
    rows = got.collect()
    assert len(rows) == len(keys)
    for r in rows:
        begin = "|".join(["numeral", "42"] + ([] if r["key"] is None else [str(r["key"])]))
        want = [n for _, n in sorted((hashlib.md5(f"{begin}|n{n}".encode()).hexdigest(), n) for n in range(1, 101))]
        lines = r["prompt"].split("\n")
        nums = [int(x.split(" -> ")[0]) for x in lines[1:-1]] + [int(lines[-1].split("number ")[1].split(" ")[0])]
        assert nums == want[: len(nums)]


def test_a_row_is_fitted_once(spark):
    rows = spark.createDataFrame([("a", "p", "1.0", "physics")], "id string, prompt string, answer string, category string")
    for df in (VA.validation_columns(rows).select("v7_answer", "v8_consistent"), VA.numeric_check(rows)):
        # the sums of products, squares and values, for either kind; c divides two of them
        assert _plan(df).count("aggregate(transform(") <= 8


def test_looking_for_an_answer_stops_at_the_first(spark):
    late = F.when(F.col("id") < 8, F.lit("a")).otherwise(F.raise_error(F.lit("read")).cast("string"))
    assert CSV._has_any_answer(spark.range(0, 10, 1, 5).select("id", late.alias("answer")))
    assert not CSV._has_any_answer(spark.range(3).select(F.lit(None).cast("string").alias("answer")))


def test_headers_are_read_without_sorting_the_lines(spark, tmp_path):
    for name, text in {"a": "id,prompt\nx,p\n", "b": "﻿id,prompt\ny,q\n", "c": "id,prompt,answer\nz,r,1\n", "d": ""}.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    first = CSV._first_lines(spark, str(tmp_path / "*.csv"))
    assert "SortAggregate" not in first._jdf.queryExecution().executedPlan().toString()
    by = {f.rsplit("/", 1)[1]: h for f, h in CSV._headers(spark, str(tmp_path / "*.csv")).items()}
    assert by["a.csv"] == by["b.csv"] != by["c.csv"]
    (tmp_path / "more").mkdir()
    for name, text in {"a": "prompt,id,note\np,x,n\n", "b": "id,prompt,answer,kind\ny,q,1,k\n"}.items():
        (tmp_path / "more" / f"{name}.csv").write_text(text)
    assert CSV.read_puzzle_glob(spark, str(tmp_path / "more" / "*.csv")).columns == ["id", "prompt", "answer", "kind", "note"]


def test_words_lie_in_as_many_parts_as_they_need(spark):
    words = spark.range(1000).select(F.col("id").cast("string").alias("word"), F.lit(1).alias("freq")).repartition(200)
    assert words.rdd.getNumPartitions() == 200
    few = TK.in_parts(words)
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and few.exceptAll(words).isEmpty() and few.count() == 1000


def test_new_words_of_many_texts_are_segmented_together(monkeypatch):
    texts = [f"ab{i}  a b　ba{i % 7}\n" * (i % 5) for i in range(60)] + [None, "", " \t"]
    trie = Trie(["", "a", "b", "ab", "▁", "▁a", "1"])
    logp = np.array([-1e6, -2.0, -2.0, -2.5, -1.0, -2.0, -3.0])
    made = []
    monkeypatch.setattr(TK, "Lattice", lambda words, trie: made.append(len(words)) or Lattice(words, trie))
    for budget in (0, 1, 5, 17, 10**6):
        made.clear()
        whole = list(TK.Cutter(trie, logp).cut_all(texts, budget))
        assert len(made) == 1
        assert whole == [TK.Cutter(trie, logp).cut(t, budget) for t in texts]


def test_two_answers_are_read_by_one_python_step(spark):
    rows = spark.createDataFrame([("1/2", "0.5"), ("x", "y"), (None, "3")], "a string, b string")
    df = rows.select(T.answers_equivalent("a", "b").alias("same"))
    assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 2  # NFKC, then values
    assert [r["same"] for r in df.collect()] == [True, False, False]
