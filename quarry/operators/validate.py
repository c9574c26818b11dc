"""Puzzle validation (JOB6): example-pair extraction and the format /
consistency rules V1-V8, plus the duplicate-id check.

Every rule is row-local: pairs are extracted into an array column once, and
the rules are higher-order functions over it (``forall``, ``exists``,
``aggregate``); bit puzzles alone go to an Arrow batch function that searches
their rules. Validation is a single map-side pass with no shuffle.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import bitrules
from quarry.functions import numbers as N
from quarry.functions import text as T

# Example-line shapes per category (applied line by line).
PAIR_PATTERNS = {
    "physics": r"(?s)^For t = ([0-9.]+)s, distance = ([0-9.]+) m$",
    "unit_conversion": r"(?s)^([0-9.]+) m becomes ([0-9.]+)$",
    "numeral_system": r"(?s)^([0-9]+) -> ([^ ]+)$",
    "bit_manipulation": r"(?s)^([^ :]+) -> ([^ :]+)$",
    "text_encryption": r"(?s)^([^:]+?) -> ([^:]*)$",
    "symbol_transformation": r"(?s)^(.+?) = (.*)$",
}
# Where the question sits in the last prompt line.
QUESTION_PATTERNS = {
    "physics": r"(?s)for t = ([0-9.]+)s given",
    "unit_conversion": r"(?s)measurement: ([0-9.]+) m",
    "numeral_system": r"(?s)write the number ([0-9]+) in",
}
NOW_LINE = r"(?s)^Now[^:]*: (.*)$"
NUMBER_2DP = r"^-?[0-9]+(\.[0-9]{1,2})?$"
BITS8 = r"^[01]{8}$"
# Characters allowed in symbol puzzles.
SYMBOL_CHARS = r"^[!@#$%^&*\[\]{}\\/|<>+\-='`~,.]+$"
NUMERAL_BASES = (2, 5, 8, 16)
# The words that decrypted phrases are asked to use.
PHRASE_WORDS = ("alice", "rabbit", "queen", "king", "wizard", "dragon", "mouse", "hatter", "turtle", "cat", "bird", "princess", "student", "teacher", "knight")


def _lines(prompt: Column) -> Column:
    return F.split(F.coalesce(prompt, F.lit("")), "\n")


def example_pairs(prompt: Column, category: Column) -> Column:
    """PRJ16: ARRAY<STRUCT<lhs, rhs>> of the example lines of the prompt's category."""
    out = F.array().cast("array<struct<lhs:string,rhs:string>>")
    for cat, pat in PAIR_PATTERNS.items():
        out = F.when(category == cat, _pairs_of(prompt, pat)).otherwise(out)
    return out


def _pairs_of(prompt: Column, pat: str) -> Column:
    def keep(line):
        return line.rlike(pat) & ~line.startswith("Now") & ~line.startswith("In Alice")

    def split(line):
        return F.struct(F.regexp_extract(line, pat, 1).alias("lhs"), F.regexp_extract(line, pat, 2).alias("rhs"))

    return F.transform(F.filter(_lines(prompt), keep), split)


def question(prompt: Column, category: Column) -> Column:
    """The value the puzzle asks about (stripped), null when not found."""
    now = F.filter(_lines(prompt), lambda l: l.rlike(NOW_LINE))
    generic = T.strip(F.regexp_extract(F.coalesce(F.try_element_at(now, F.lit(-1)), F.lit("")), NOW_LINE, 1))
    out = F.when(F.size(now) > 0, generic)
    for cat, pat in QUESTION_PATTERNS.items():
        out = F.when(category == cat, F.when(prompt.rlike(pat), F.regexp_extract(prompt, pat, 1))).otherwise(out)
    return out


def _all_pairs(pairs: Column, q: Column, answer: Column) -> Column:
    """Example pairs plus (question, answer); missing parts become ''."""
    qa = F.struct(F.coalesce(q, F.lit("")).alias("lhs"), F.coalesce(answer, F.lit("")).alias("rhs"))
    return F.concat(pairs, F.array(qa))


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, b: a + b)


def _fit(pairs: Column, square_x: bool):
    """Least squares through the origin: (c, sum x, sum x^2) with x = lhs (or lhs^2)."""

    def xv(p):
        x = p["lhs"].try_cast("double")
        return x * x if square_x else x

    sxy = _sum(F.transform(pairs, lambda p: xv(p) * p["rhs"].try_cast("double")))
    sxx = _sum(F.transform(pairs, lambda p: xv(p) * xv(p)))
    sx = _sum(F.transform(pairs, lambda p: xv(p)))
    return F.try_divide(sxy, sxx), sx, sxx


def _fit_column(pairs: Column, phys: Column, unit: Column) -> Column:
    """The fit of a row's own kind as one struct (null for other kinds), to be a column of
    its own: rules that look at every pair would otherwise fit anew for each."""

    def of(square_x: bool) -> Column:
        return F.struct(*[x.alias(k) for k, x in zip(("c", "sx", "sxx"), _fit(pairs, square_x))])

    return F.when(phys, of(True)).when(unit, of(False))


def _tolerance(xq: Column, sx: Column, sxx: Column) -> Column:
    # answer rounding (0.005) + worst case of the fitted coefficient times xq
    return F.lit(0.005) + F.lit(0.005) * F.try_divide(xq * sx, sxx)


def _bits_consistent(pairs: Column) -> Column:
    """One rule of ``functions.bitrules`` for all pairs, the answer last (null in, null out)."""

    @F.pandas_udf("boolean")
    def search(p: pd.Series) -> pd.Series:
        return p.map(bitrules.pairs_consistent).astype(object)

    return search(pairs)


def _char_map_consistent(allp: Column) -> Column:
    same_len = F.forall(allp, lambda p: F.length(p["lhs"]) == F.length(p["rhs"]))
    mapping = F.flatten(
        F.transform(
            allp,
            lambda p: F.when(
                F.length(p["lhs"]) > 0,
                F.transform(F.sequence(F.lit(1), F.length(p["lhs"])), lambda i: F.struct(F.substring(p["lhs"], i, 1).alias("s"), F.substring(p["rhs"], i, 1).alias("d"))),
            ).otherwise(F.array().cast("array<struct<s:string,d:string>>")),
        )
    )
    functional = F.size(F.array_distinct(mapping)) == F.size(F.array_distinct(F.transform(mapping, lambda m: m["s"])))
    return same_len & functional


def _base_renderer(b: int):
    def render(s):
        return F.upper(F.conv(s, 10, b))

    return render


def _numeral_ok(allp: Column) -> Column:
    def fits(render):
        return F.forall(allp, lambda p: p["lhs"].rlike("^[0-9]+$") & (F.upper(p["rhs"]) == render(p["lhs"])))

    systems = [fits(lambda s: N.int_to_roman(s.try_cast("bigint")))]
    for b in NUMERAL_BASES:
        systems.append(fits(_base_renderer(b)))
    out = systems[0]
    for s in systems[1:]:
        out = out | s
    return out


def validation_columns(df: DataFrame, prompt: str = "prompt", answer: str = "answer", category: str = "category", raw: str | None = None) -> DataFrame:
    """Adds ``n_pairs`` and one boolean per rule (null where a rule does not apply):

    v1_bits, v2_text (phrases of 2 to 4 words), v2_words (decrypted words of the list), v3_numeric, v4_numeral, v5_symbol, v6_markers (only with
    ``raw``), v7_answer (recomputed numeric answer), v8_consistent."""
    p, a, c = F.col(prompt), F.col(answer), F.col(category)
    base = df.withColumn("_pairs", example_pairs(p, c)).withColumn("_q", question(p, c))
    pairs, q = F.col("_pairs"), F.col("_q")
    allp = _all_pairs(pairs, q, a)
    n = F.size(pairs)
    phys, unit = c == "physics", c == "unit_conversion"
    base = base.withColumn("_fit", _fit_column(pairs, phys, unit)).withColumn(
        "_numbers", F.when(phys | unit, F.forall(allp, lambda x: F.coalesce(x["lhs"].rlike(NUMBER_2DP) & x["rhs"].rlike(NUMBER_2DP), F.lit(False))))
    )
    v1 = F.when(c == "bit_manipulation", n.between(3, 8) & F.forall(allp, lambda x: F.coalesce(x["lhs"].rlike(BITS8) & x["rhs"].rlike(BITS8), F.lit(False))))
    v2 = F.when(
        c == "text_encryption",
        (n > 0) & F.forall(allp, lambda x: F.coalesce(T.word_count(x["lhs"]).between(2, 4) & T.word_count(x["rhs"]).between(2, 4), F.lit(False))),
    )
    v2w = F.when(c == "text_encryption", (n > 0) & F.forall(allp, lambda x: F.forall(T.words(x["rhs"]), lambda w: w.isin(*PHRASE_WORDS))))
    numbers_ok, (fit_c, sx, sxx) = F.col("_numbers"), (F.col("_fit")[k] for k in ("c", "sx", "sxx"))
    g_ok = (2 * fit_c).between(4.99, 20.01)
    v3 = F.when(phys, (n > 0) & numbers_ok & F.coalesce(g_ok, F.lit(False))).when(unit, (n > 0) & numbers_ok)
    v4 = F.when(c == "numeral_system", (n > 0) & F.coalesce(_numeral_ok(allp), F.lit(False)))
    v5 = F.when(
        c == "symbol_transformation",
        (n > 0)
        & F.forall(pairs, lambda x: F.length(x["lhs"]).between(4, 8))
        & F.forall(allp, lambda x: F.coalesce(x["lhs"].rlike(SYMBOL_CHARS) & x["rhs"].rlike(SYMBOL_CHARS), F.lit(False))),
    )
    xq = q.try_cast("double")
    ans = a.try_cast("double")
    ok_p = F.abs(ans - fit_c * xq * xq) <= _tolerance(xq * xq, sx, sxx)
    ok_u = F.abs(ans - fit_c * xq) <= _tolerance(xq, sx, sxx)
    v7 = F.when(phys, F.coalesce((n > 0) & numbers_ok & a.rlike(NUMBER_2DP) & ok_p, F.lit(False))).when(
        unit, F.coalesce((n > 0) & numbers_ok & a.rlike(NUMBER_2DP) & ok_u, F.lit(False))
    )

    def ex_ok(square):
        def one(x):
            xv = x["lhs"].try_cast("double")
            xv = xv * xv if square else xv
            return F.abs(x["rhs"].try_cast("double") - fit_c * xv) <= _tolerance(xv, sx, sxx)

        return F.forall(pairs, one)

    v8 = (
        F.when(phys, F.coalesce(F.col("v7_answer") & ex_ok(True), F.lit(False)))
        .when(unit, F.coalesce(F.col("v7_answer") & ex_ok(False), F.lit(False)))
        .when(c == "numeral_system", F.col("v4_numeral"))
        .when(c == "bit_manipulation", (n > 0) & F.coalesce(_bits_consistent(F.when(c == "bit_manipulation", allp)), F.lit(False)))
        .when(c.isin("text_encryption", "symbol_transformation"), (n > 0) & F.coalesce(_char_map_consistent(allp), F.lit(False)))
    )
    out = base.withColumn("n_pairs", n.cast("bigint"))
    cols = {"v1_bits": v1, "v2_text": v2, "v2_words": v2w, "v3_numeric": v3, "v4_numeral": v4, "v5_symbol": v5, "v7_answer": v7, "v8_consistent": v8}
    if raw:
        r = F.col(raw)
        before = F.split_part(r, F.lit("PROMPT:"), F.lit(1))
        after = F.split_part(r, F.lit("ANSWER:"), F.lit(2))
        after_lines = F.filter(F.split(T.strip(after), "\n"), lambda l: T.strip(l) != "")
        cols["v6_markers"] = r.contains("PROMPT:") & r.contains("ANSWER:") & (T.strip(before) == "") & (F.size(after_lines) <= 1)
    for k, v in cols.items():
        out = out.withColumn(k, v)
    return out.drop("_pairs", "_q", "_fit", "_numbers")


def numeric_check(df: DataFrame, prompt: str = "prompt", answer: str = "answer", category: str = "category") -> DataFrame:
    """V7 details for physics / unit rows: fitted coefficient, predicted answer, verdict."""
    p, a, c = F.col(prompt), F.col(answer), F.col(category)
    num = df.where(c.isin("physics", "unit_conversion"))
    num = num.withColumn("_pairs", example_pairs(p, c)).withColumn("_q", question(p, c))
    pairs, q = F.col("_pairs"), F.col("_q")
    phys = c == "physics"
    num = num.withColumn("_fit", _fit_column(pairs, phys, ~phys))
    coef, sx, sxx = (F.col("_fit")[k] for k in ("c", "sx", "sxx"))
    xq = q.try_cast("double")
    pred = F.when(phys, coef * xq * xq).otherwise(coef * xq)
    tol = F.when(phys, _tolerance(xq * xq, sx, sxx)).otherwise(_tolerance(xq, sx, sxx))
    return num.select(
        "id",
        category,
        F.round(coef, 6).alias("coefficient"),
        F.round(pred, 6).alias("predicted"),
        F.coalesce(F.abs(a.try_cast("double") - pred) <= tol, F.lit(False)).alias("answer_ok"),
    )


def duplicate_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """AGG16: ids that occur more than once, with their counts (partial
    aggregation first, so a hot id is never collected in one task)."""
    return df.groupBy(id_col).agg(F.count(F.lit(1)).cast("bigint").alias("n")).where(F.col("n") > 1)
