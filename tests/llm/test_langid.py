import itertools
import math

import numpy as np
import pytest

from quarry.llm import langid_pieces as L
from quarry.llm.common import read

from .edge import documents, rows_of


PIECES = ["", "a", "ab", "b", "c", "▁", "▁a", "bc"]
PROB = np.array([[0.01, 0.02], [0.2, 0.1], [0.1, 0.2], [0.15, 0.1], [0.1, 0.1], [0.2, 0.2], [0.1, 0.05], [0.14, 0.23]])


def exact(word, k):
    """The forward sum in whole numbers: probabilities are hundredths, sums at position j are in 100^-j."""
    ids, s = {p: i for i, p in enumerate(PIECES) if p}, "▁" + word
    alpha = [1]
    for j in range(1, len(s) + 1):
        total = 0
        for i in range(max(0, j - 2), j):
            p = ids.get(s[i:j], 0 if i == j - 1 else None)
            if p is not None:
                total += alpha[i] * round(PROB[p][k] * 100) * 100 ** (j - i - 1)
        alpha.append(total)
    return math.log(alpha[-1]) - len(s) * math.log(100)


def test_forward_sums_all_segmentations():
    words = ["abc", "zab", "a", "é日", "b" * 9 + "c"]
    ll = L.Lattice(["▁" + w for w in words], L.Trie(PIECES)).log_likelihood(np.log(PROB))

    def brute(s, k):
        ids, total = {p: i for i, p in enumerate(PIECES) if p}, 0.0
        for cuts in itertools.product((0, 1), repeat=len(s) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(s)]
            parts = [s[a:b] for a, b in zip(at, at[1:])]
            ps = [PROB[ids[p]][k] if p in ids else PROB[0][k] if len(p) == 1 else 0.0 for p in parts]
            total += math.prod(ps)
        return math.log(total)

    for w, k in itertools.product(range(len(words)), range(2)):
        assert ll[w, k] == pytest.approx(brute("▁" + words[w], k))


def test_long_words_are_scored_whole(monkeypatch):
    """60 and 5,000 letters against exact sums; the same when the word goes in blocks."""
    words = ["abc" * 20, "abcbz" * 1000, "z" * 60]
    want = [[exact(w, k) for k in range(2)] for w in words]
    trie, logp = L.Trie(PIECES), np.log(PROB)
    assert L.settle(words, trie, logp) == pytest.approx(np.array(want), rel=1e-12)
    monkeypatch.setattr(L, "LONG", 37)
    assert L.settle(words, trie, logp) == pytest.approx(np.array(want), rel=1e-12)


def test_unknown_scripts_keep_their_difference():
    prob = np.array([[1e-7, 3e-7], [0.5, 0.5]])
    ll = L.settle(["ж" * 45], L.Trie(["", "a"]), np.log(prob))[0]
    assert ll[1] - ll[0] == pytest.approx(46 * math.log(3))


def test_expected_uses_match_a_derivative():
    """Expected uses of a piece are the derivative of the log-likelihood by its log-probability."""
    pieces = ["", "a", "ab", "b", "▁", "ba"]
    prob = np.array([0.01, 0.3, 0.2, 0.2, 0.2, 0.09])
    lat, count = L.Lattice(["▁abab", "▁bab", "▁xba"], L.Trie(pieces)), np.array([2.0, 5.0, 1.0])
    uses = lat.expected(np.log(prob), count)
    for p in range(len(pieces)):
        up, down = np.log(prob), np.log(prob)
        up[p] += 1e-6
        down[p] -= 1e-6
        d = (count @ lat.log_likelihood(up[:, None])[:, 0] - count @ lat.log_likelihood(down[:, None])[:, 0]) / 2e-6
        assert uses[p] == pytest.approx(d, abs=1e-4)


def test_clashing_names(spark):
    docs = documents(spark)
    for c in ("_p", "_score", "_lang", "row", "p", "a.b"):
        docs = docs.withColumn(c, L.F.lit("kept"))
    docs = docs.withColumn("m", L.F.create_map(L.F.lit("k"), L.F.lit(1)))
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns
    assert all(r[c] == "kept" for r in rows_of(kept) for c in ("_p", "_score", "_lang", "row", "p", "a.b"))
    assert {"_lang", "_score", "a.b", "_p"} < set(L.identify(docs).columns)


def test_held_out_accuracy(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text", "lang")
    rows = rows_of(L.identify(docs).where(L.held_out(L.F.col("doc_id")) & L.F.col("lang").isNotNull()))
    assert len(rows) > 20
    assert sum(r["lang"] == r["_lang"] for r in rows) / len(rows) >= 0.95
    assert all(0.0 <= r["_score"] <= 1.0 for r in rows)


def test_edges(spark):
    docs = documents(spark)
    got = {(r["doc_id"], r["text"]): (r["_lang"], r["_score"]) for r in rows_of(L.identify(docs))}
    for i, t in ((3, None), (4, ""), (5, " \t\n "), (8, "12 34 !!")):
        assert got[i, t] == ("und", 0.0)
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns and not {3, 4, 5, 8} & {r["doc_id"] for r in rows_of(kept)}
    assert sum(r["doc_id"] == 2 for r in rows_of(kept)) == 2
    assert L.identify(docs.limit(0)).count() == 0
    unlabelled = docs.withColumn("lang", L.F.lit(None).cast("string"))
    assert {r["_lang"] for r in rows_of(L.identify(unlabelled))} == {"und"}


def test_prediction_ignores_labels(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text", "lang")
    pieces = L.load_pieces()
    langs, prob = L.fit(docs.where(~L.held_out(L.F.col("doc_id"))), pieces)
    a = {r["doc_id"]: (r["_lang"], round(r["_score"], 9)) for r in rows_of(L.predict(docs, pieces, langs, prob))}
    other = docs.withColumn("lang", L.F.lit("xx")).withColumn("doc_id", L.F.col("doc_id") + 1)
    assert a == {r["doc_id"] - 1: (r["_lang"], round(r["_score"], 9)) for r in rows_of(L.predict(other, pieces, langs, prob))}
