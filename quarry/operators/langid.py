"""Language identification as a Spark job (FLT9): character-trigram naive
Bayes with add-one smoothing, fitted on labelled documents and applied to
whole texts.

    log p(tri | lang) = log(c(lang, tri) + 1) - log(T_lang + V)
    score(doc, lang)  = sum over the doc's trigram occurrences of log(c + 1)
                        - n_trigrams(doc) * log(T_lang + V)

Only trigrams seen in a language contribute to the first term, so a text is
scored row by row against one packed table: three code points of 21 bits are a
key, the sorted keys and one weight per key and language are broadcast, and an
Arrow batch function sums a text's weights slice by slice. A document stays one
row, nothing is shuffled, and no id is needed: rows that share one, or have
none, are scored each on their own. The table's size is checked first; a larger
model meets (row, trigram) counts in a salted shuffle join instead.
Fitting reads at most about ``fit_rows`` labelled rows, chosen by hash of id.
The model (up to the checked size), its row count and the labels' normalisers
are the only values read back to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.hashing import hex8_to_long, seeded_hash
from quarry.session import ensure_checkpoint_dir
from quarry.sources.scratch import written

# A packed trigram takes eight bytes and eight more per language: the table is
# broadcast up to about 40 MB at four languages; a larger model (many scripts
# and languages) is joined by a shuffle on trigram and salt.
MAX_BROADCAST_MODEL_ROWS = 1_000_000
POINT_BITS = 21
SLICE = 1 << 18  # characters looked up at once
FIT_ROWS = 50_000  # about so many labelled rows are fitted, however many there are
FIT_SEED = 42
SALTS = 16


def padded_text(text) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.concat(F.lit(" "), T.collapse_ws(T.strip(F.lower(F.coalesce(c, F.lit(""))))), F.lit(" "))


# every overlapping 3-character window in one linear regex pass (a zero-width
# lookahead match at each position); per-position substring() would rescan
# the UTF-8 bytes from the start each time and be quadratic in the text length
TRIGRAM = "(?s)(?=(.{3}))"


def trigrams(padded: Column) -> Column:
    return F.regexp_extract_all(padded, F.lit(TRIGRAM), 1)


def fit_draw(id_col: str = "doc_id") -> Column:
    """A row's draw in [0, 1) for the fitting sample."""
    return hex8_to_long(seeded_hash("langfit", FIT_SEED, id_col)) / F.lit(float(1 << 32))


def fit(docs: DataFrame, text: str = "text", label: str = "lang", id_col: str = "doc_id", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Sparse model (lang, tri, c) over about ``fit_rows`` labelled documents (all
    of them where there are fewer), checkpointed (it is read three times:
    vocabulary size, language totals, scoring join)."""
    ensure_checkpoint_dir(docs.sparkSession)
    lab = docs.where(F.col(label).isNotNull())
    lab = lab.where(fit_draw(id_col) * F.lit(lab.count()) < F.lit(fit_rows))
    counted = lab.select(F.col(label).cast("string").alias("lang"), padded_text(text).alias("t")).mapInArrow(_count_trigrams, "lang string, tri string, c bigint")
    return counted.groupBy("lang", "tri").agg(F.sum("c").alias("c")).checkpoint(eager=True)


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, tri, c) of each batch's texts: one row per distinct trigram of some texts, not one per character."""
    for b in batches:
        held: dict[str, list] = {}
        letters = 0
        for lang, t in zip(b.column("lang").to_pylist(), b.column("t").to_pylist()):
            points = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
            for a in range(0, len(points) - 2, SLICE):
                held.setdefault(lang, []).append(_trigram_keys(points[a : a + SLICE + 2].astype(np.int64)))
                letters += len(held[lang][-1])
                if letters > 16 * SLICE:
                    yield from _trigram_rows(held)
                    held, letters = {}, 0
        yield from _trigram_rows(held)


def _trigram_rows(held: dict[str, list]) -> Iterator[pa.RecordBatch]:
    for lang, parts in held.items():
        keys, n = np.unique(np.concatenate(parts), return_counts=True)
        points = np.stack([(keys >> (i * POINT_BITS)) & ((1 << POINT_BITS) - 1) for i in (2, 1, 0)], axis=1).astype(np.uint32)
        chars = points.tobytes().decode("utf-32-le", "surrogatepass")
        tri = [chars[i : i + 3] for i in range(0, len(chars), 3)]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(tri), pa.string()), pa.array(tri, pa.string()), pa.array(n.astype(np.int64))], ["lang", "tri", "c"])


def language_constants(model: DataFrame) -> list[tuple[str, float]]:
    """(lang, log(T_lang + V)) per class label, sorted by label. One small
    aggregate: the number of classes bounds its size."""
    v = model.select(F.countDistinct("tri")).first()[0]
    rows = model.groupBy("lang").agg(F.sum("c").alias("t")).collect()
    return sorted((r["lang"], math.log(r["t"] + v)) for r in rows)


def packed(model: DataFrame, consts: list[tuple[str, float]]) -> tuple[np.ndarray, np.ndarray]:
    """(sorted trigram keys, weight per key and language); at most the checked number of rows."""
    rows = model.toPandas()
    points = np.frombuffer("".join(rows["tri"]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64).reshape(-1, 3)
    keys, at = np.unique(_trigram_keys(points.reshape(-1))[::3] if len(points) else np.zeros(0, np.int64), return_inverse=True)
    weight = np.zeros((len(keys), len(consts)))
    place = {lang: i for i, (lang, _) in enumerate(consts)}
    weight[at, rows["lang"].map(place).to_numpy(int)] = np.log(rows["c"].to_numpy(float) + 1)
    return keys, weight


def _trigram_keys(points: np.ndarray) -> np.ndarray:
    return (points[:-2] << (2 * POINT_BITS)) | (points[1:-1] << POINT_BITS) | points[2:]


def text_scores(padded: str, keys: np.ndarray, weight: np.ndarray, logden: np.ndarray) -> np.ndarray:
    """Score of one padded text in each language."""
    points = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32)
    total, n = np.zeros(len(logden)), max(0, len(points) - 2)
    for a in range(0, n, SLICE):
        own = _trigram_keys(points[a : a + SLICE + 2].astype(np.int64))
        at = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
        if len(keys):
            total += weight[at[keys[at] == own]].sum(0)
    return total - n * logden


def _in_rows(docs: DataFrame, model: DataFrame, consts, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((*packed(model, consts), np.array([c for _, c in consts]), [lang for lang, _ in consts]))

    @F.pandas_udf("string")
    def best(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        keys, weight, logden, langs = shared.value
        for s in parts:
            # equal scores go to the first, smaller code
            yield s.map(lambda t: langs[int(text_scores(t, keys, weight, logden).argmax())] if langs else None).astype(object)

    return docs.withColumn("predicted", best(padded_text(text)))


def _by_join(docs: DataFrame, model: DataFrame, consts, text: str) -> DataFrame:
    """The same for a model too large to broadcast: numbered rows, stored once, meet it trigram by trigram."""
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "langid-rows")
    wcols = [f"_w{i}" for i in range(len(consts))]
    lw = F.log(F.col("c") + 1)
    wide = model.groupBy("tri").agg(*[F.sum(F.when(F.col("lang") == lang, lw)).alias(c) for (lang, _), c in zip(consts, wcols)])
    padded = rows.select("_row", padded_text(text).alias("_t"))
    occ = padded.select("_row", F.greatest(F.length("_t") - 2, F.lit(0)).alias("_n"), F.explode_outer(trigrams(F.col("_t"))).alias("tri"))
    # left join: a document whose trigrams are all unseen still keeps its row
    counted = occ.groupBy("_row", "_n", "tri").agg(F.count(F.lit(1)).alias("_k")).withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(SALTS)).cast("int"))
    found = counted.join(wide.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["tri", "_salt"], "left")
    per_row = found.groupBy("_row", "_n").agg(*[F.coalesce(F.sum(F.col(c) * F.col("_k")), F.lit(0.0)).alias(c) for c in wcols])
    scores = F.array(*[F.struct((F.col(c) - F.col("_n") * F.lit(logden)).alias("score"), F.lit(lang).alias("lang")) for (lang, logden), c in zip(consts, wcols)])
    best = F.array_max(F.transform(F.col("_s"), lambda x: x["score"]))
    pred = F.array_min(F.transform(F.filter(F.col("_s"), lambda x: x["score"] == best), lambda x: x["lang"]))
    return rows.join(per_row.withColumn("_s", scores).select("_row", pred.alias("predicted")), "_row").drop("_row")


def with_language(docs: DataFrame, model: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with its ``predicted`` language (ties to the smaller
    code; a column of that name is replaced)."""
    consts = language_constants(model)
    small = model.count() <= MAX_BROADCAST_MODEL_ROWS
    return (_in_rows if small else _by_join)(docs.drop("predicted"), model, consts, text)


def score(docs: DataFrame, model: DataFrame, text: str = "text", id_col: str = "doc_id", carry: Sequence[str] = ()) -> DataFrame:
    """Per document row: id, the ``carry`` columns and the ``predicted`` language."""
    return with_language(docs.select(*dict.fromkeys([id_col, text, *carry])), model, text).select(id_col, *carry, "predicted")


def identify(docs: DataFrame, train: DataFrame | None = None, text: str = "text", label: str = "lang", id_col: str = "doc_id", carry: Sequence[str] = (), fit_rows: int = FIT_ROWS) -> DataFrame:
    """Fit on ``train`` (default: the labelled rows of ``docs``) and label every row of ``docs``."""
    model = fit(train if train is not None else docs, text, label, id_col, fit_rows)
    return score(docs, model, text, id_col, carry)


def language_filter(docs: DataFrame, keep: str = "en", train: DataFrame | None = None, text: str = "text", label: str = "lang", id_col: str = "doc_id", fit_rows: int = FIT_ROWS) -> DataFrame:
    """FLT9: the rows identified as ``keep``, each judged by its own text, whatever its id."""
    model = fit(train if train is not None else docs, text, label, id_col, fit_rows)
    return with_language(docs, model, text).where(F.col("predicted") == keep).select(*docs.columns)
