"""Language identification by segmentation-marginalised unigrams.

For every language a probability per piece of a fixed public vocabulary (a
path; read by the driver, broadcast). A word's likelihood is the sum over all
its segmentations into pieces, by the forward algorithm; a text's is the product
over its words. The piece probabilities are fitted by expectation-maximisation
on a bounded sample of labelled rows; every text is scored whole.

Words are runs of letters, lower-cased, with a mark in front; a letter without
a piece of its own costs the unknown piece. Sums are kept as logarithms, so a
word of any length is scored over all its segmentations. Distinct words are
settled once per task, all new words of a batch together in numpy: a flat trie is
walked from every position at once, then the sums go position by position. Words
over ``LONG`` letters go in blocks that hand on the last sums, in bounded memory;
they teach nothing.

Null text and text without letters: ``und``, score 0. Rows without label or text
teach nothing. Without any learned language, and in an empty table, all rows are
``und``. Ties go to the language first in code-point order. Repeated rows get
equal results. Other columns are left alone, whatever their names; ``_lang`` and
``_score`` of ``identify`` and ``predict`` replace columns of these names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.lattice import Lattice, Trie
from quarry.llm.common import fields_of, quoted, read, whole_rows
from quarry.llm.registry import query

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ROWS_PER_LANGUAGE = 400  # about so many labelled rows of each language are fitted
ROUNDS = 4
ALPHA = 0.05  # added to every piece's expected count
LONG = 1 << 18  # letters of a word that are held at once
CHUNK = 1 << 18  # letters of new words that are settled together
CACHED_WORDS = 200_000
WORD = re.compile(r"[^\W\d_]+")
MARK = "▁"


def load_pieces(path: str = VOCABULARY) -> list[str]:
    """The vocabulary's lower-case pieces of letters, with or without the word mark; the unknown piece is number 0."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    kept = [p for p in pieces if (b := p.removeprefix(MARK)) == b.lower() and (b.isalpha() or p == MARK)]
    return ["", *sorted(set(kept))]


def words_of(text: str | None) -> Counter:
    """Lower-cased letter runs with their counts."""
    found = Counter(WORD.findall(text.lower())) if text else Counter()
    for w in [w for w in found if not w.isascii() and not any(c.isalpha() for c in w)]:
        del found[w]
    return found


def settle(words: list[str], trie: Trie, logp: np.ndarray) -> np.ndarray:
    """Log-likelihood of each word, a column per language: short ones in chunks, a long one block by block."""
    out, held, letters = np.zeros((len(words), logp.shape[1])), [], 0
    for i in sorted(range(len(words)), key=lambda i: len(words[i])):
        if len(words[i]) > LONG:
            out[i] = _settle_long(words[i], trie, logp)
            continue
        held.append(i)
        letters += len(words[i])
        if letters > CHUNK:
            out[held] = Lattice([MARK + words[j] for j in held], trie).log_likelihood(logp)
            held, letters = [], 0
    if held:
        out[held] = Lattice([MARK + words[j] for j in held], trie).log_likelihood(logp)
    return out


def _settle_long(word: str, trie: Trie, logp: np.ndarray) -> np.ndarray:
    """A block begins ``longest`` letters before the last one's end, at sums that are known."""
    back, total = trie.longest, np.zeros(logp.shape[1])
    alpha = Lattice([MARK + word[:LONG]], trie).forward(logp)
    for at in range(LONG, len(word), LONG):
        seeds = alpha[-(back + 1) :]
        least = seeds.max(0)
        total, seeds = total + least, seeds - least
        # the mark in front of a block takes the place of a letter whose edges are all known
        alpha = Lattice([MARK + word[at - back + 1 : at + LONG]], trie).forward(logp, seeds)
    return total + alpha[-1]


def fit(labelled: DataFrame, pieces: list[str], rows_per_language: int = ROWS_PER_LANGUAGE, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """(languages, probabilities[piece, language]) from (doc_id, text, lang) rows.

    The sample takes rows by hash of id, so about ``rows_per_language`` of each
    language however many there are; word counts are made on Spark, and one task
    per language fits its bounded counts. A row per language and used piece
    reaches the driver."""
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("fit")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = known.join(F.broadcast(sizes), "lang").where(draw * F.col("n") < rows_per_language)
    spark = labelled.sparkSession
    shared = spark.sparkContext.broadcast(pieces)

    def count_words(batches):
        for b in batches:
            total: dict[str, Counter] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                total.setdefault(lang, Counter()).update(words_of(text))
            rows = [(lang, w, n) for lang, c in total.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["lang", "word", "n"])

    def fit_language(key: tuple, words: pd.DataFrame) -> pd.DataFrame:
        vocab = shared.value
        words = words[words["word"].str.len() <= LONG].sort_values("word")
        lattice = Lattice([MARK + w for w in words["word"]], Trie(vocab))
        count, prob = words["n"].to_numpy(float), np.full(len(vocab), 1.0 / len(vocab))
        for _ in range(rounds if len(words) else 0):
            uses = lattice.expected(np.log(prob), count)
            prob = (uses + ALPHA) / (uses.sum() + ALPHA * len(vocab))
        used = np.flatnonzero(prob > prob.min())
        return pd.DataFrame({"lang": key[0], "piece": np.append(used, -1), "prob": np.append(prob[used], prob.min())})

    counts = sample.select("lang", "text").mapInArrow(count_words, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    model = counts.groupBy("lang").applyInPandas(fit_language, "lang string, piece int, prob double").toPandas()
    langs = sorted(model["lang"].unique())
    prob = np.zeros((len(pieces), len(langs)))
    for k, lang in enumerate(langs):
        own = model[model["lang"] == lang]
        prob[:, k] = own.loc[own["piece"] == -1, "prob"].iloc[0]
        rest = own[own["piece"] >= 0]
        prob[rest["piece"].to_numpy(), k] = rest["prob"].to_numpy()
    return langs, prob


def _scorer(pieces: list[str], langs: list[str], prob: np.ndarray):
    """Texts to (language, score); remembers the words it has settled."""
    trie, logp = Trie(pieces), np.log(prob)
    seen: dict[str, int] = {}
    table = np.zeros((0, len(langs)))

    def score(texts):
        nonlocal table
        if len(seen) > CACHED_WORDS:
            seen.clear()
            table = np.zeros((0, len(langs)))
        counts = [words_of(t) for t in texts]
        fresh = list(dict.fromkeys(w for c in counts for w in c if w not in seen))
        if fresh and langs:
            table = np.concatenate((table, settle(fresh, trie, logp)))
            seen.update(zip(fresh, range(len(seen), len(seen) + len(fresh))))
        out = []
        for c in counts:
            if not c or not langs:
                out.append(("und", 0.0))
                continue
            ll = np.fromiter(c.values(), float, len(c)) @ table[[seen[w] for w in c]]
            best = int(ll.argmax())
            out.append((langs[best], float(1.0 / np.exp(ll - ll[best]).sum())))
        return out

    return score


def _scored(docs: DataFrame, pieces: list[str], langs: list[str], prob: np.ndarray, text: str) -> DataFrame:
    """(row, p): each row as one struct, so that no name of it can clash, and its language and score."""
    shared = docs.sparkSession.sparkContext.broadcast((pieces, langs, prob))

    @F.pandas_udf("struct<lang:string,score:double>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = _scorer(*shared.value)
        for s in parts:
            out = []
            for a in range(0, len(s), 256):
                out += score(s.iloc[a : a + 256])
            yield pd.DataFrame(out, columns=["lang", "score"])

    return whole_rows(docs, p=run(quoted(text)))


def predict(docs: DataFrame, pieces: list[str], langs: list[str], prob: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with _lang and _score added."""
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("_lang", "_score")]
    return _scored(docs, pieces, langs, prob, text).select(*kept, F.col("p.lang").alias("_lang"), F.col("p.score").alias("_score"))


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that teach nothing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learned(docs: DataFrame, vocabulary: str = VOCABULARY) -> tuple[list[str], list[str], np.ndarray]:
    """Pieces, languages and probabilities from the labelled rows that are not held out."""
    pieces = load_pieces(vocabulary)
    return pieces, *fit(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"), pieces)


def identify(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with _lang and _score; learns from the labelled rows that are not held out."""
    return predict(docs, *learned(docs, vocabulary))


def keep_identified(docs: DataFrame, min_score: float = 0.5, vocabulary: str = VOCABULARY) -> DataFrame:
    """Documents whose language is known with at least ``min_score``."""
    scored = _scored(docs, *learned(docs, vocabulary), "text").where((F.col("p.lang") != "und") & (F.col("p.score") >= min_score))
    return scored.select(*fields_of(docs))


@query("op4_language_id")
def op4_language_id(spark, d):
    """Predicted language and its posterior probability for every whole document."""
    docs = read(spark, d, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))
