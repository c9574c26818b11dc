"""Lattice kernels against brute-force enumeration of all segmentations; the fitted sweep; texts cut by pieces."""

import math
import random

import numpy as np
import pytest

from quarry.functions.lattice import Lattice, Trie
from quarry.operators import tokenizer as TK

PROB = {"▁": 0.1, "a": 0.1, "b": 0.1, "ab": 0.2, "▁a": 0.15, "▁ab": 0.05, "ba": 0.1, "bab": 0.2}
PIECES = ["", *PROB]
LOGP = np.array([TK.UNKNOWN, *map(math.log, PROB.values())])
WORDS = ["▁ab", "▁abab", "▁babab", "▁aab", "▁", "a"]


def segmentations(w, vocab):
    if not w:
        yield []
        return
    for j in range(1, len(w) + 1):
        if w[:j] in vocab or j == 1:
            for rest in segmentations(w[j:], vocab):
                yield [w[:j]] + rest


def weight(s):
    return sum(math.log(PROB[p]) if p in PROB else TK.UNKNOWN for p in s)


def best(w, vocab=PROB):
    """The best segmentation; of equal ones the longest last piece, then the longest before it."""
    return max(segmentations(w, vocab), key=lambda s: (round(weight(s), 9), [len(p) for p in s[::-1]]))


def test_expected_uses_brute_force():
    freq = np.arange(1.0, len(WORDS) + 1)
    want = np.zeros(len(PIECES))
    for w, f in zip(WORDS, freq):
        segs = list(segmentations(w, PROB))
        z = sum(math.exp(weight(s)) for s in segs)
        for s in segs:
            for p in s:
                want[PIECES.index(p)] += f * math.exp(weight(s)) / z
    assert TK.expected_uses(WORDS, freq, Trie(PIECES), LOGP) == pytest.approx(want)


def test_best_segmentation_brute_force():
    lattice = Lattice(WORDS, Trie(PIECES))
    score, count, edge = lattice.best(LOGP)
    for w, e, ends in zip(WORDS, lattice.end, lattice.ends(edge)):
        want = best(w)
        assert score[e] == pytest.approx(weight(want)) and count[e] == len(want)
        assert ends == np.cumsum([len(p) for p in want]).tolist()


def test_loss_is_the_best_replacement():
    uses = np.arange(1.0, len(PIECES) + 1)
    got = TK.losses(PIECES[1:], uses[1:], LOGP[1:], Trie(PIECES), LOGP)
    for i, p in enumerate(PIECES[1:], 1):
        if len(p) == 1:
            assert got[i - 1] == math.inf
        else:
            other = max(weight(s) for s in segmentations(p, PROB.keys() - {p}))
            assert got[i - 1] == pytest.approx(uses[i] * (math.log(PROB[p]) - other))


def test_trie_of_some_pieces():
    keep = np.array([0, 1, 2, 4, 7])
    some = Trie(PIECES).only(keep)
    fresh = Trie([PIECES[i] for i in keep])
    for w in WORDS:
        a, b = (sorted(zip(x.start.tolist(), x.stop.tolist(), x.p.tolist())) for x in (Lattice([w], some), Lattice([w], fresh)))
        assert a == b


def test_unknown_characters_count_one_each():
    assert TK.piece_counts(["▁zz", "▁日本"], Trie(["", "▁"]), np.array([TK.UNKNOWN, -1.0])).tolist() == [3, 3]


def test_long_words_do_not_underflow():
    w = ["▁" + "ab" * 3000]
    lattice = Lattice(w, Trie(PIECES))
    assert np.isfinite(lattice.log_likelihood(LOGP[:, None])).all()
    uses = TK.expected_uses(w, np.array([1.0]), Trie(PIECES), LOGP)
    assert sum(u * len(p) for u, p in zip(uses, PIECES)) == pytest.approx(6001)


def test_sweep_reaches_its_sizes_and_improves(spark):
    r = random.Random(1)
    stems = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(3, 7))) for _ in range(40)]
    rows = [(" ".join(r.choice(stems) + r.choice(["", "ing", "ed"]) for _ in range(8)),) for _ in range(150)]
    df = spark.createDataFrame(rows, "prompt string")
    words = TK.word_frequencies(df, ["prompt"])
    models = TK.fit_sweep(words, (40, 80), seed_factor=6)
    assert {k: m.size for k, m in models.items()} == {40: 40, 80: 80}
    assert all({c for w in stems for c in w} <= set(m.pieces) for m in models.values())
    out = {x["vocab_size"]: x for x in TK.token_totals(words, models).collect()}
    total = sum(len(w) + 1 for t, in rows for w in t.split())
    n_words = sum(len(t.split()) for t, in rows)
    assert n_words <= out[80]["total_tokens"] < out[40]["total_tokens"] < total
    # EM never lowers the likelihood
    table = {x["word"]: x["freq"] for x in words.collect()}
    ll = lambda m: float(Lattice(list(table), Trie(m.pieces)).log_likelihood(m.logp[:, None])[:, 0] @ np.array(list(table.values()), float))
    before = models[80]
    assert ll(TK.em_step(words, before)) >= ll(before) - 1e-6


def test_cut_against_brute_force():
    cutter = TK.Cutter(Trie(PIECES), LOGP)
    r = random.Random(2)
    for _ in range(200):
        text = "".join(r.choice("ab z\n\u3000") for _ in range(r.randrange(12)))
        at, ends = 0, []
        for w in text.split():
            at = text.index(w, at)
            own = np.cumsum([len(p) for p in best("▁" + w)])
            ends += [at + int(e) - 1 for e in own]
            at += len(w)
        for budget in range(len(ends) + 2):
            want = len(text) if budget >= len(ends) else ends[budget - 1] if budget else 0
            assert cutter.cut(text, budget) == (len(ends), want)


def test_cut_of_awkward_texts(spark):
    model = TK.Model(PIECES, np.exp(LOGP))
    long = "abab 😀 " * 150_000  # a megabyte
    rows = [(1, None), (1, ""), (2, " \t"), (3, "ab ab ab ab"), (4, "😀😀 ab"), (5, long), (5, "a" * 300_000)]
    out = [(x["i"], x["n_pieces"], x["text_cut"]) for x in TK.truncate_to_pieces(spark.createDataFrame(rows, "i int, text string"), model, 3).collect()]
    assert out[0] == (1, 0, None) and out[1] == (1, 0, "") and out[2] == (2, 0, " \t")
    assert out[4][2] == "😀😀" and out[3][2].startswith("ab") and len(out[5][2]) <= 8
    assert out[5][1] > 450_000
    whole = TK.truncate_to_pieces(spark.createDataFrame(rows, "i int, text string"), model, 10**9).collect()
    assert [x["text_cut"] for x in whole] == [t for _, t in rows]
