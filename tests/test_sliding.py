import random
import time

from quarry.operators import curate as C
from quarry.operators import tokenizer as TK
from quarry.plans import jobs as J
from quarry.plans import views as V


def brute(words, n, window, step):
    best = 0.0
    for s in range(0, max(len(words) - window, 0) + 1, step):
        part = words[s : s + window]
        grams = [tuple(part[i : i + n]) for i in range(len(part) - n + 1)]
        if grams:
            best = max(best, 1 - len(set(grams)) / len(grams))
    return best


def test_sliding_share_equals_every_window_counted():
    draw = random.Random(1)
    for _ in range(400):
        words = [draw.choice("abcd"[: draw.randint(1, 4)]) for _ in range(draw.randint(0, 40))]
        n, step = draw.randint(1, 4), draw.randint(1, 5)
        window = draw.randint(n, 15)
        assert abs(C._least_distinct(words, n, window, step) - brute(words, n, window, step)) < 1e-12


def test_sliding_rows(spark):
    texts = [None, "", "a", "a b", "a b c", "x y z " * 100, " ".join(map(str, range(500))), "a\u00a0b\u2003c\x1ca b c"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    wide = C.sliding_repetition(C.repetition_columns(df, "text", step=1), "text", step=1).orderBy("id").collect()
    assert [round(r["rep_share_windowed"], 12) for r in wide] == [round(r["rep_share_sliding"], 12) for r in wide]


def test_long_text_is_linear():
    words = [str(i % 997) for i in range(1_000_000)]
    t0 = time.perf_counter()
    assert C._least_distinct(words, 3, 200, 1) == 0
    assert time.perf_counter() - t0 < 20


def test_profile_with_vocabularies(spark, sf):
    ex = V.examples(spark, sf)
    got = J.profile_dataset(ex, vocab_sizes=(300,))["vocabulary"].collect()
    assert got == TK.vocabulary_sweep(ex, (300,)).collect()
    assert "vocabulary" not in J.profile_dataset(ex)
