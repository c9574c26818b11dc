"""Golden edge cases for the text expressions (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import numbers as N
from quarry.functions import text as T

EXTRACT = [
    ("\\boxed{42}", "42"),
    ("a \\boxed{ 7 } \\boxed{8}", "7"),
    ("\\boxed{}", "\\boxed{}"),
    ("\\boxed{\\frac{3}{4}}", "\\boxed{\\frac{3}{4}}"),
    ("\n\n  first \nsecond<|im_end|>", "first"),
    ("", ""),
    (None, ""),
    ("\\boxed{   }", ""),
    ("<|im_end|>", ""),
    ("\\boxed{4<eos>2}", "42"),
    ("<think>\nx\n</think>\n5", "<think>"),
    ("a\x0bb", "a"),
    ("\x1c q", "q"),
    ("\\boxed{a\nb}", "a\nb"),
]

NORMALIZE = [
    ("ＡＢＣ\u3000１", "ABC 1"),
    ("½", "1\u20442"),
    ("a\u00a0\u00a0b", "a b"),
    (" x\t\ny ", "x y"),
    ("\ufb01", "fi"),
    (None, ""),
]

PARSE = [
    ("PROMPT: p\nq\nANSWER: a\nrest", ("p\nq", "a")),
    ("PROMPT: p ANSWER:\n\n a", ("p", "a")),
    ("PROMPT: a PROMPT: b ANSWER: c", ("a", "c")),
    ("PROMPT: p ANSWER: a ANSWER: b", ("p", "a")),
    ("ANSWER: a PROMPT: p", ("p", "a PROMPT: p")),
    ("PROMPT: ANSWER: x", (None, None)),
    ("prompt: p answer: a", (None, None)),
    ("", (None, None)),
    (None, (None, None)),
    ("noise PROMPT: p ANSWER: a", ("p", "a")),
]

ROMAN = {0: "", 1: "I", 4: "IV", 9: "IX", 11: "XI", 15: "XV", 38: "XXXVIII", 40: "XL", 90: "XC", 94: "XCIV", 99: "XCIX", 100: "C"}


def _one(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_extract_final_answer(spark):
    got = _one(spark, [v for v, _ in EXTRACT], T.extract_final_answer)
    assert got == [e for _, e in EXTRACT]


def test_normalize_answer(spark):
    got = _one(spark, [v for v, _ in NORMALIZE], T.normalize_answer)
    assert got == [e for _, e in NORMALIZE]


def test_raw_answer_and_strip_match_python(spark):
    samples = [" a ", "\u3000x\u2028", "\x1cq\x1f", "a b", "", None, "\x85z\xa0"]
    got = _one(spark, samples, T.raw_answer)
    assert got == [(s or "").strip() for s in samples]


def test_word_count_matches_python_split(spark):
    samples = ["a b  c", "\u2003x\u3000y\x1d", "", None, "one", "x\x85y\u2029z"]
    got = _one(spark, samples, T.word_count)
    assert got == [len(s.split()) if s is not None else 0 for s in samples]


def test_parse_prompt_answer(spark):
    vals = [v for v, _ in PARSE]
    ps = _one(spark, vals, T.parse_prompt)
    ans = _one(spark, vals, T.parse_answer)
    assert list(zip(ps, ans)) == [e for _, e in PARSE]


def test_roman(spark):
    df = spark.createDataFrame([(k,) for k in ROMAN], "n int")
    got = {r[0]: r[1] for r in df.select("n", N.int_to_roman("n")).collect()}
    assert got == ROMAN


@pytest.mark.parametrize("h,txt", [(10000, "100.0"), (15460, "154.6"), (15462, "154.62"), (105, "1.05"), (7, "0.07")])
def test_hundredths_text(spark, h, txt):
    df = spark.createDataFrame([(h,)], "h long")
    assert df.select(N.hundredths_text("h")).first()[0] == txt == str(round(h / 100, 2))


def test_render_templates(spark):
    df = spark.createDataFrame([("p", "a", None)], "p string, a string, n string")
    r = df.select(T.render_training_text("p", "a"), T.render_generation_prompt("p")).first()
    assert r[0] == "<|im_start|>user\np<|im_end|>\n<|im_start|>assistant\na<|im_end|>"
    assert r[1] == "<|im_start|>user\np<|im_end|>\n<|im_start|>assistant\n"
    with pytest.raises(Exception):
        df.select(T.render_training_text("p", "n")).collect()


def test_canonical_equivalence(spark):
    rows = [("3/4", "0.75"), ("\\frac{3}{4}", "0.75"), ("1/0", "1/0"), ("abc", " abc "), ("2", "3")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r[0] for r in df.select(T.answers_equivalent("a", "b")).collect()]
    assert got == [True, True, True, True, False]
