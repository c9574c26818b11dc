"""Language scoring inside the row: against the plain sums, and with repeated and missing ids."""

import math
from collections import Counter, defaultdict

import pytest

from quarry.operators import langid as L
from quarry.plans import jobs as J

EN = "the quick brown fox jumps over the lazy dog and then it runs away through the wood"
ES = "el veloz zorro marron salta sobre el perro perezoso y luego corre lejos por el bosque"
SCHEMA = "doc_id bigint, text string, lang string, source string"
TRAIN = [(i, EN if i % 2 else ES, "en" if i % 2 else "es", "s") for i in range(20)]


def brute(text, rows):
    counts = defaultdict(Counter)
    tri = lambda t: [t[i : i + 3] for i in range(len(t) - 2)]
    pad = lambda t: " " + " ".join((t or "").lower().split()) + " "
    for _, t, lang, _ in rows:
        counts[lang].update(tri(pad(t)))
    v = len({x for c in counts.values() for x in c})
    score = {k: sum(math.log((c[x] + 1) / (sum(c.values()) + v)) for x in tri(pad(text))) for k, c in counts.items()}
    return min(score, key=lambda k: (-score[k], k))


@pytest.mark.parametrize("packed", [True, False])
def test_rows_are_scored_by_their_own_text(spark, monkeypatch, packed):
    if not packed:
        monkeypatch.setattr(L, "MAX_BROADCAST_MODEL_ROWS", 0)
    train = spark.createDataFrame(TRAIN, SCHEMA)
    rows = [(1, EN, None, "a"), (1, ES, None, "a"), (None, EN, None, None), (2, None, None, "b"), (2, "", None, "b"), (3, "日本語 the 😀 fox " * 50, None, "c"), (3, "zz qq", None, "c")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = Counter((r["doc_id"], r["text"], r["predicted"]) for r in L.identify(docs, train, carry=["text"]).collect())
    assert got == Counter((i, t, brute(t, TRAIN)) for i, t, *_ in rows)
    kept = L.language_filter(docs, "en", train=train)
    assert kept.columns == docs.columns
    want = Counter((i, t) for i, t, *_ in rows if brute(t, TRAIN) == "en")
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == want
    assert want[1, EN] == 1 and want[1, ES] == 0 and want[None, EN] == 1


def test_slices_of_a_long_text(monkeypatch):
    import numpy as np

    keys = np.sort(L._trigram_keys(np.array([ord(c) for c in "the cat "], np.int64)))
    weight, den = np.arange(len(keys) * 2, dtype=float).reshape(-1, 2), np.array([1.0, 2.0])
    whole = L.text_scores("the cat sat " * 100, keys, weight, den)
    monkeypatch.setattr(L, "SLICE", 7)
    assert np.allclose(L.text_scores("the cat sat " * 100, keys, weight, den), whole)


def test_curation_keeps_rows_not_ids(spark):
    train = spark.createDataFrame(TRAIN, SCHEMA)
    rows = [(7, f"{EN} number {i}", None, "a" if i % 3 else None) for i in range(30)] + [(7, ES, None, "a"), (None, EN, None, "a"), (8, "word " * 60, None, "a")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for size in (10, 200):
        out = J.curate_corpus(docs, size, train=train).collect()
        assert len(out) == min(size, 31)
        assert all(EN in r["text"] for r in out) and len({(r["doc_id"], r["text"]) for r in out}) == len(out)
