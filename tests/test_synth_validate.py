"""Synthesis properties and validation rules."""

from pyspark.sql import functions as F

from quarry.operators import synth as Y
from quarry.operators import validate as VA


def _seeds(spark, n=300):
    return spark.range(n).select(F.col("id").alias("key"))


def test_numeral_question_not_in_examples(spark):
    p = Y.numeral_system(_seeds(spark), "key").collect()
    for r in p:
        lines = r["prompt"].split("\n")
        nums = [int(l.split(" -> ")[0]) for l in lines[1:-1]]
        q = int(lines[-1].split("number ")[1].split(" ")[0])
        assert 4 <= len(nums) <= 6 and len(set(nums)) == len(nums) and q not in nums
        assert all(1 <= n <= 100 for n in nums + [q])


def test_physics_unit_pass_numeric_verification(spark):
    s = _seeds(spark, 500)
    rows = Y.physics(s, "key").unionByName(Y.unit_conversion(s, "key")).select(
        F.col("key").cast("string").alias("id"), "prompt", "answer", "category"
    )
    v = VA.validation_columns(rows).select("v3_numeric", "v7_answer", "v8_consistent").collect()
    assert all(r["v3_numeric"] and r["v7_answer"] and r["v8_consistent"] for r in v)


def test_physics_matches_python_formula(spark):
    for r in Y.physics(_seeds(spark, 50), "key").collect():
        lines = r["prompt"].split("\n")
        t = [float(l.split("t = ")[1].split("s,")[0]) for l in lines[1:-1]]
        d = [float(l.split("distance = ")[1].split(" m")[0]) for l in lines[1:-1]]
        g = 2 * sum(di * ti * ti for ti, di in zip(t, d)) / sum(ti**4 for ti in t)
        assert 4.9 <= g <= 20.1


def test_rules_on_handwritten_puzzles(spark):
    rows = [
        ("b1", "x\n01010001 -> 10100010\n00001001 -> 00010010\n11000000 -> 10000001\nNow, determine the output for: 00000011", "00000110", "bit_manipulation"),
        ("b2", "x\n01010001 -> 11011101\n00001001 -> 0110110\n10000000 -> 00000001\nNow, determine the output for: 10010111", "10010111", "bit_manipulation"),
        ("t1", "x\nucoov pwgtfyoqg -> queen discovers\nNow, decrypt the following text: ucoov pwgtfyoqg", "queen discovers", "text_encryption"),
        ("t2", "x\nab cd -> xy zw\nNow, decrypt the following text: aa cd", "xz zw", "text_encryption"),
        ("n1", "x\n11 -> XI\n15 -> XV\n94 -> XCIV\nNow, write the number 38 in the Wonderland numeral system.", "XXXVIII", "numeral_system"),
        ("n2", "x\n5 -> 101\n6 -> 110\n7 -> 111\nNow, write the number 2 in the Wonderland numeral system.", "10", "numeral_system"),
        ("s1", "x\n!*[{ = @#]}\n!!** = @@##\nNow, determine the result for: [{", "]}", "symbol_transformation"),
    ]
    df = spark.createDataFrame(rows, "id string, prompt string, answer string, category string")
    got = {r["id"]: r for r in VA.validation_columns(df).collect()}
    assert got["b1"]["v1_bits"] and got["b1"]["v8_consistent"]  # rotate left by 1
    assert got["b2"]["v1_bits"] is False  # 7-digit output
    assert got["t1"]["v2_text"] is True and got["t1"]["v8_consistent"] is True
    assert got["t2"]["v2_text"] is True and got["t2"]["v8_consistent"] is False  # 'a' maps to x and z
    assert got["n1"]["v4_numeral"] and got["n2"]["v4_numeral"]
    assert got["s1"]["v5_symbol"] and got["s1"]["v8_consistent"]


def test_quota_stops_at_attempt_cap(spark):
    rows = [("bit_manipulation", i, 0, "junk" if i < 5 else f"PROMPT: p{i}\nANSWER: a{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "category string, conv_id long, turn long, text string")
    got = Y.quota_per_category(df, 2).orderBy("id").collect()  # first 6 attempts: only #5 parses
    assert [r["id"] for r in got] == ["syn_bit_00000"]
    assert got[0]["prompt"] == "p5"
    got = Y.quota_per_category(df, 4).collect()  # first 12 attempts: 7 parse, keep 4
    assert sorted(r["prompt"] for r in got) == ["p5", "p6", "p7", "p8"]
