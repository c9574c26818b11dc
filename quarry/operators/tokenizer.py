"""Vocabulary-size sweep (AGG10): a unigram sub-word language model (Kudo,
2018) fitted by EM as Spark jobs, prompt token totals per vocabulary size, and
texts cut to a number of pieces (PRJ18).

Work is over the table of *distinct* words with their frequencies (one
shuffle), never over raw text:

* seed pieces: every substring of ``▁word`` up to 16 characters, extracted in
  linear regex passes, summed per piece (partial aggregation), the top
  ``seed_factor x largest size`` by frequency x length kept; every single
  character is always kept;
* E-step: Arrow batches of distinct words become lattices over a flat trie
  (``functions.lattice``); a task adds up the expected uses of all its words and
  gives one row per piece used, summed per piece by Spark;
* pruning by loss: each piece's best segmentation without itself is found in
  tasks over the pieces; what the likelihood loses, expected uses x (log
  probability of the piece - that of its replacement), ranks the pieces on Spark,
  and at most a quarter of them go each round until the target size;
* token totals: best segmentation of each distinct prompt word x frequency.

The model is the piece list and one number per piece, at most
``seed_factor x size`` of them; it is sent to the tasks once per round, and a
round is one job for the E-step and one for the losses.

Intended differences from the SentencePiece library: text is pre-split on
whitespace, piece ids are not comparable, totals are close but not equal. If
the text cannot support a size, the size reached is reported.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate, chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.lattice import Lattice, Trie
from quarry.session import materialize

SPACE = "▁"  # word-start marker
MAX_PIECE = 16
SEED_FACTOR = 10
SHRINK = 0.75
EM_STEPS = 2
MAX_MODEL_PIECES = 500_000  # seed_factor x the largest size, checked before the seeds are read
UNKNOWN = -1e6  # log weight of a character without a piece: one token each
LEAST = 1e-12  # expected uses below this count as this much
LETTERS = 1 << 18  # letters of words settled together
CACHED_WORDS = 200_000
WORDS_PER_TASK = 20_000  # distinct words of one task of an E-step
WORD = re.compile(r"\S+")  # the words of functions.text, as spans


def word_frequencies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(word, freq) over the whitespace-split words of ``cols`` joined by a space;
    words carry the word-start marker."""
    line = F.concat_ws(" ", *[F.col(c) for c in cols])
    w = df.select(F.explode(T.words(line)).alias("w"))
    return w.groupBy(F.concat(F.lit(SPACE), F.col("w")).alias("word")).agg(F.count(F.lit(1)).alias("freq"))


def seed_pieces(words: DataFrame, size: int) -> DataFrame:
    """(piece, freq): the ``size`` best substrings by freq x length plus every character."""
    arrays = [F.regexp_extract_all(F.col("word"), F.lit(f"(?s)(?=(.{{{n}}}))"), 1) for n in range(1, MAX_PIECE + 1)]
    subs = words.select("freq", F.explode(F.flatten(F.array(*arrays))).alias("piece"))
    cnt = subs.groupBy("piece").agg(F.sum("freq").alias("freq"))
    chars = cnt.where(F.length("piece") == 1)
    multi = cnt.where(F.length("piece") > 1).orderBy((F.col("freq") * F.length("piece")).desc(), F.col("piece")).limit(size)
    return chars.unionByName(multi)


# ---------------------------------------------------------------- the model


class Model:
    """Pieces (number 0 is the unknown one) with their log probabilities, expected uses and trie."""

    def __init__(self, pieces: list[str], uses: np.ndarray, trie: Trie | None = None):
        self.pieces, self.uses = pieces, uses
        known = np.maximum(uses[1:], LEAST)
        self.logp = np.concatenate(([UNKNOWN], np.log(known) - np.log(known.sum())))
        # a trie keeps the nodes of pieces that went, until they are more than those that stayed
        self.trie = trie if trie is not None and trie.built < 2 * len(pieces) else self._grown()

    def _grown(self) -> Trie:
        trie = Trie(self.pieces)
        trie.built = len(self.pieces)
        return trie

    @property
    def size(self) -> int:
        return len(self.pieces) - 1

    def only(self, keep: np.ndarray) -> Model:
        """The model of some of its pieces."""
        at = np.concatenate(([0], np.sort(keep)))
        return Model([self.pieces[i] for i in at], self.uses[at], self.trie.only(at))


def seed_model(seeds: DataFrame) -> Model:
    """The seeds with their counts as uses, ordered by piece; at most MAX_MODEL_PIECES are read."""
    rows = seeds.limit(MAX_MODEL_PIECES + 1).toPandas().sort_values("piece")
    if len(rows) > MAX_MODEL_PIECES:
        raise ValueError(f"more than {MAX_MODEL_PIECES} seed pieces")
    return Model(["", *rows["piece"]], np.concatenate(([0.0], rows["freq"].to_numpy(float))))


def in_chunks(words: list[str]) -> Iterator[np.ndarray]:
    """Places of words of like length, so many letters at a time."""
    order = np.argsort([len(w) for w in words], kind="stable")
    held, letters = [], 0
    for i in order.tolist():
        held.append(i)
        letters += len(words[i])
        if letters > LETTERS:
            yield np.array(held)
            held, letters = [], 0
    if held:
        yield np.array(held)


def expected_uses(words: list[str], freq: np.ndarray, trie: Trie, logp: np.ndarray) -> np.ndarray:
    total = np.zeros(len(logp))
    for at in in_chunks(words):
        total += Lattice([words[i] for i in at], trie).expected(logp, freq[at])
    return total


def piece_counts(words: list[str], trie: Trie, logp: np.ndarray) -> np.ndarray:
    """Pieces in the best segmentation of each word."""
    out = np.zeros(len(words), np.int64)
    for at in in_chunks(words):
        lattice = Lattice([words[i] for i in at], trie)
        out[at] = lattice.best(logp)[1][lattice.end]
    return out


def losses(pieces: list[str], uses: np.ndarray, own: np.ndarray, trie: Trie, logp: np.ndarray) -> np.ndarray:
    """What the likelihood loses without each piece: uses x (its log probability - its best replacement's).
    Infinite for single characters, which always stay."""
    out = np.full(len(pieces), np.inf)
    several = np.flatnonzero([len(p) > 1 for p in pieces])
    for at in in_chunks([pieces[i] for i in several]):
        at = several[at]
        lattice = Lattice([pieces[i] for i in at], trie, whole=False)
        out[at] = uses[at] * (own[at] - lattice.best(logp)[0][lattice.end])
    return out


# ---------------------------------------------------------------- Spark steps


def em_step(words: DataFrame, model: Model) -> Model:
    """One round of EM over (word, freq); pieces that are no longer used go, characters stay."""
    bc = words.sparkSession.sparkContext.broadcast((model.trie, model.logp))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, logp = bc.value
        total = np.zeros(len(logp))
        for b in batches:
            total += expected_uses(b.column("word").to_pylist(), b.column("freq").to_numpy(zero_copy_only=False).astype(float), trie, logp)
        # one row per piece and task: a map-side combine before the shuffle
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["piece", "uses"])

    rows = words.mapInArrow(run, "piece int, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas()
    bc.unpersist()
    uses = np.zeros(len(model.pieces))
    uses[rows["piece"].to_numpy()] = rows["uses"].to_numpy()
    uses[0] = 0.0
    single = np.array([len(p) == 1 for p in model.pieces])
    return Model(model.pieces, uses, model.trie).only(np.flatnonzero((uses > LEAST) | single))


def prune(spark: SparkSession, model: Model, keep: int) -> Model:
    """Every single character and the pieces whose loss is largest, ``keep`` in all (ties by piece)."""
    bc = spark.sparkContext.broadcast((model.trie, model.pieces, model.logp, model.uses))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, pieces, logp, uses = bc.value
        for b in batches:
            at = b.column("id").to_numpy()
            loss = losses([pieces[i] for i in at], uses[at], logp[at], trie, logp)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(loss)], ["piece", "loss"])

    chars = np.flatnonzero([len(p) == 1 for p in model.pieces])
    ranked = spark.range(1, len(model.pieces)).mapInArrow(run, "piece int, loss double").where(F.col("loss") < float("inf"))
    best = ranked.orderBy(F.desc("loss"), "piece").limit(max(0, keep - len(chars))).toPandas()["piece"].to_numpy()
    bc.unpersist()
    return model.only(np.concatenate((chars, best)).astype(int))


def in_parts(words: DataFrame) -> DataFrame:
    """Stored words in as many parts as their number asks for, a part for every core at
    least. They lie in as many as the shuffle that counted them had, which follows the texts'
    size and not theirs; each round gives each part a Python task and the whole model."""
    cores = words.sparkSession.sparkContext.defaultParallelism
    return words.coalesce(max(cores, -(-words.count() // WORDS_PER_TASK)))


def fit_sweep(words: DataFrame, sizes: Sequence[int], seed_factor: int = SEED_FACTOR) -> dict[int, Model]:
    """Fit the largest size first and continue pruning to the smaller ones: {size: model}."""
    spark = words.sparkSession
    sizes = sorted(set(sizes), reverse=True)
    words = in_parts(materialize(words))
    model = em_step(words, seed_model(seed_pieces(words, seed_factor * sizes[0])))
    out: dict[int, Model] = {}
    for target in sizes:
        # one EM step per pruning round, EM_STEPS once the size is reached; a
        # smaller size continues from the re-estimated model of the larger one
        while model.size > target:
            before = model.size
            model = em_step(words, prune(spark, model, max(target, int(model.size * SHRINK))))
            if model.size == before:
                break  # nothing is left but single characters
        for _ in range(EM_STEPS - 1):
            model = em_step(words, model)
        out[target] = model
    return out


def token_totals(prompt_words: DataFrame, models: dict[int, Model]) -> DataFrame:
    """Per vocabulary size: pieces reached and total tokens over the prompt words, all sizes in one pass."""
    spark = prompt_words.sparkSession
    bc = spark.sparkContext.broadcast({size: (m.trie, m.logp) for size, m in models.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(bc.value, 0)
        for b in batches:
            words, freq = b.column("word").to_pylist(), b.column("freq").to_numpy(zero_copy_only=False)
            for size, (trie, logp) in bc.value.items():
                total[size] += int(piece_counts(words, trie, logp) @ freq)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["vocab_size", "tokens"])

    reached = F.create_map(*[F.lit(x).cast("bigint") for size, m in models.items() for x in (size, m.size)])
    totals = prompt_words.mapInArrow(run, "vocab_size bigint, tokens bigint").groupBy("vocab_size").agg(F.sum("tokens").alias("total_tokens"))
    return totals.select("vocab_size", reached[F.col("vocab_size")].alias("pieces"), "total_tokens")


def vocabulary_sweep(df: DataFrame, sizes: Sequence[int] = (4000, 8000, 16000), fit_cols=("prompt", "answer"), count_col: str = "prompt") -> DataFrame:
    """AGG10: fit on prompt + answer, count tokens over prompts only."""
    models = fit_sweep(word_frequencies(df, list(fit_cols)), sizes)
    return token_totals(word_frequencies(df, [count_col]), models)


# ---------------------------------------------------------------- texts cut to a number of pieces


class Cutter:
    """Cuts texts after so many pieces of their words; remembers the words it has segmented."""

    def __init__(self, trie: Trie, logp: np.ndarray):
        self.trie, self.logp, self.seen = trie, logp, {}

    def _learn(self, words: list[str]) -> None:
        if len(self.seen) > CACHED_WORDS:
            self.seen.clear()
        fresh = [w for w in dict.fromkeys(words) if w not in self.seen]
        for at in in_chunks(fresh):
            lattice = Lattice([SPACE + fresh[i] for i in at], self.trie)
            # ends in the word itself: the mark is a letter of no width
            for i, ends in zip(at.tolist(), lattice.ends(lattice.best(self.logp)[2])):
                self.seen[fresh[i]] = [e - 1 for e in ends]

    def cut(self, text: str | None, budget: int) -> tuple[int, int]:
        """(pieces in the whole text, code points that hold the first ``budget`` of them)."""
        return next(self.cut_all([text], budget))

    def cut_all(self, texts: Iterable[str | None], budget: int) -> Iterator[tuple[int, int]]:
        """``cut`` of each text; the new words of so many letters of text are segmented together."""
        held, letters = [], 0
        for text in texts:
            held.append(text or "")
            letters += len(held[-1])
            if letters > LETTERS:
                yield from self._cut_held(held, budget)
                held, letters = [], 0
        yield from self._cut_held(held, budget)

    def _cut_held(self, texts: list[str], budget: int) -> Iterator[tuple[int, int]]:
        split = [text.split() for text in texts]  # the words of WORD
        self._learn(list(chain.from_iterable(split)))
        for text, words in zip(texts, split):
            pieces = list(accumulate(map(len, map(self.seen.__getitem__, words))))
            total = pieces[-1] if pieces else 0
            if total <= budget:
                yield total, len(text)
            elif budget <= 0:
                yield total, 0
            else:
                at = bisect_left(pieces, budget)  # the word that holds the last piece
                start = next(islice(WORD.finditer(text), at, None)).start()
                yield total, start + self.seen[words[at]][budget - (pieces[at - 1] if at else 0) - 1]


def truncate_to_pieces(df: DataFrame, model: Model, budget: int, text: str = "text", out: str = "text_cut", pieces: str = "n_pieces") -> DataFrame:
    """PRJ18 in real pieces: ``text`` cut right after its ``budget``-th piece (whole where
    it has no more), and the number of pieces of the whole text. Null has none and stays null."""
    bc = df.sparkSession.sparkContext.broadcast((model.trie, model.logp))

    @F.pandas_udf("struct<n:bigint,cut:bigint>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cutter = Cutter(*bc.value)
        for s in parts:
            yield pd.DataFrame(list(cutter.cut_all(s, budget)), columns=["n", "cut"])

    cut = df.withColumn("_cut", run(F.col(text)))
    return cut.withColumn(out, F.substring(F.col(text), F.lit(1), F.col("_cut.cut").cast("int"))).withColumn(pieces, F.col("_cut.n")).drop("_cut")
