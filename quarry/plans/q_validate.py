"""Validation queries (JOB6): example pairs, format rules, numeric
verification, consistency, marker hygiene, duplicate ids, augmentation union."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import validate as VA
from quarry.plans import q_synth as QS
from quarry.plans import sqltext as S
from quarry.plans import views as V
from quarry.plans.registry import query
from quarry.sources.tables import table

# ------------------------------------------------------------ SQL builders


def _forall(lst: str, lam: str) -> str:
    return f"coalesce(list_bool_and(list_transform({lst}, {lam})), true)"


def _exists(lst: str, lam: str) -> str:
    return f"coalesce(list_bool_or(list_transform({lst}, {lam})), false)"


def _lines(p: str) -> str:
    return f"string_split(coalesce({p}, ''), chr(10))"


def _pairs_sql(p: str, c: str) -> str:
    out = "CAST([] AS STRUCT(lhs VARCHAR, rhs VARCHAR)[])"
    for cat, pat in VA.PAIR_PATTERNS.items():
        lines = (
            f"list_filter({_lines(p)}, lambda l: regexp_matches(l, {S.q(pat)}) AND NOT starts_with(l, 'Now') "
            "AND NOT starts_with(l, 'In Alice'))"
        )
        pairs = f"list_transform({lines}, lambda l: {{'lhs': regexp_extract(l, {S.q(pat)}, 1), 'rhs': regexp_extract(l, {S.q(pat)}, 2)}})"
        out = f"CASE WHEN {c} = {S.q(cat)} THEN {pairs} ELSE {out} END"
    return out


def _question_sql(p: str, c: str) -> str:
    now = f"list_filter({_lines(p)}, lambda l: regexp_matches(l, {S.q(VA.NOW_LINE)}))"
    out = f"CASE WHEN len({now}) > 0 THEN {S.strip(f'regexp_extract({now}[-1], {S.q(VA.NOW_LINE)}, 1)')} END"
    for cat, pat in VA.QUESTION_PATTERNS.items():
        out = f"CASE WHEN {c} = {S.q(cat)} THEN (CASE WHEN regexp_matches({p}, {S.q(pat)}) THEN regexp_extract({p}, {S.q(pat)}, 1) END) ELSE {out} END"
    return out


def _sum(lst: str, lam: str) -> str:
    return f"coalesce(list_sum(list_transform({lst}, {lam})), 0.0)"


def _x(e: str, square: bool) -> str:
    x = f"TRY_CAST({e}.lhs AS DOUBLE)"
    return f"({x} * {x})" if square else x


def _fit_cols(square: bool, tag: str) -> str:
    xv = _x("e", square)
    return (
        f"{_sum('pairs', f'lambda e: {xv} * TRY_CAST(e.rhs AS DOUBLE)')} AS sxy_{tag}, "
        f"{_sum('pairs', f'lambda e: {xv} * {xv}')} AS sxx_{tag}, {_sum('pairs', f'lambda e: {xv}')} AS sx_{tag}"
    )


def _div(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END)"


def _tol(xq: str, tag: str) -> str:
    return f"(0.005 + 0.005 * {_div(f'{xq} * sx_{tag}', f'sxx_{tag}')})"


_BITS8 = S.q(VA.BITS8)
_NUM2 = S.q(VA.NUMBER_2DP)
_SYM = S.q(VA.SYMBOL_CHARS)


def _stage1(src: str) -> str:
    """id, category, prompt, answer, pairs, q, allp and the two fits."""
    inner = f"SELECT *, {_pairs_sql('prompt', 'category')} AS pairs, {_question_sql('prompt', 'category')} AS q FROM {src}"
    mid = f"SELECT *, list_concat(pairs, [{{'lhs': coalesce(q, ''), 'rhs': coalesce(answer, '')}}]) AS allp FROM ({inner})"
    return f"SELECT *, {_fit_cols(True, 'p')}, {_fit_cols(False, 'u')} FROM ({mid})"


def _rules(with_v8: bool = True) -> dict[str, str]:
    n = "len(pairs)"
    numbers_ok = _forall("allp", f"lambda x: coalesce(regexp_matches(x.lhs, {_NUM2}) AND regexp_matches(x.rhs, {_NUM2}), false)")
    c_p, c_u = _div("sxy_p", "sxx_p"), _div("sxy_u", "sxx_u")
    xq, ans = "TRY_CAST(q AS DOUBLE)", "TRY_CAST(answer AS DOUBLE)"
    v1 = (
        f"CASE WHEN category = 'bit_manipulation' THEN {n} BETWEEN 3 AND 8 AND "
        f"{_forall('allp', f'lambda x: coalesce(regexp_matches(x.lhs, {_BITS8}) AND regexp_matches(x.rhs, {_BITS8}), false)')} END"
    )
    v2 = (
        f"CASE WHEN category = 'text_encryption' THEN {n} > 0 AND "
        + _forall("allp", f"lambda x: coalesce({S.word_count('x.lhs')} BETWEEN 2 AND 4 AND {S.word_count('x.rhs')} BETWEEN 2 AND 4, false)")
        + " END"
    )
    v3 = (
        f"CASE WHEN category = 'physics' THEN {n} > 0 AND {numbers_ok} AND coalesce(2 * {c_p} BETWEEN 4.99 AND 20.01, false) "
        f"WHEN category = 'unit_conversion' THEN {n} > 0 AND {numbers_ok} END"
    )
    systems = [f"upper(x.rhs) = {S.int_to_roman('TRY_CAST(x.lhs AS BIGINT)')}"] + [
        f"upper(x.rhs) = upper(to_base(TRY_CAST(x.lhs AS BIGINT), {b}))" for b in VA.NUMERAL_BASES
    ]
    numeral_ok = " OR ".join(_forall("allp", f"lambda x: coalesce(regexp_matches(x.lhs, '^[0-9]+$') AND {s}, false)") for s in systems)
    v4 = f"CASE WHEN category = 'numeral_system' THEN {n} > 0 AND coalesce({numeral_ok}, false) END"
    v5 = (
        f"CASE WHEN category = 'symbol_transformation' THEN {n} > 0 AND "
        + _forall("pairs", "lambda x: length(x.lhs) BETWEEN 4 AND 8")
        + " AND "
        + _forall("allp", f"lambda x: coalesce(regexp_matches(x.lhs, {_SYM}) AND regexp_matches(x.rhs, {_SYM}), false)")
        + " END"
    )
    ok_p = f"abs({ans} - {c_p} * {xq} * {xq}) <= {_tol(f'({xq} * {xq})', 'p')}"
    ok_u = f"abs({ans} - {c_u} * {xq}) <= {_tol(xq, 'u')}"
    v7 = (
        f"CASE WHEN category = 'physics' THEN coalesce({n} > 0 AND {numbers_ok} AND regexp_matches(answer, {_NUM2}) AND {ok_p}, false) "
        f"WHEN category = 'unit_conversion' THEN coalesce({n} > 0 AND {numbers_ok} AND regexp_matches(answer, {_NUM2}) AND {ok_u}, false) END"
    )
    v2w = f"CASE WHEN category = 'text_encryption' THEN {n} > 0 AND " + _forall("allp", f"lambda x: list_has_all([{', '.join(map(S.q, VA.PHRASE_WORDS))}], {S.words('x.rhs')})") + " END"
    out = {"v1_bits": v1, "v2_text": v2, "v2_words": v2w, "v3_numeric": v3, "v4_numeral": v4, "v5_symbol": v5, "v7_answer": v7}
    if with_v8:
        xp, xu = _x("x", True), _x("x", False)
        ex_p = _forall("pairs", f"lambda x: abs(TRY_CAST(x.rhs AS DOUBLE) - {c_p} * {xp}) <= {_tol(xp, 'p')}")
        ex_u = _forall("pairs", f"lambda x: abs(TRY_CAST(x.rhs AS DOUBLE) - {c_u} * {xu}) <= {_tol(xu, 'u')}")
        pairs_at = "list_distinct(list_transform(allp, lambda p: substr(p.lhs, i, 1) || substr(p.rhs, i, 1)))"
        bad_at = f"(list_contains({pairs_at}, '00') AND list_contains({pairs_at}, '01')) OR (list_contains({pairs_at}, '10') AND list_contains({pairs_at}, '11'))"
        xor_ok = f"len(list_filter(range(1, 9), lambda i: {bad_at})) = 0"

        def rule(expr):
            return _exists("range(1, 8)", f"lambda r: {_forall('allp', f'lambda p: {expr} = p.rhs')}")

        rot = rule("substr(p.lhs, r + 1, 8) || substr(p.lhs, 1, r)")
        shl = rule("substr(p.lhs, r + 1, 8) || repeat('0', r)")
        shr = rule("repeat('0', r) || substr(p.lhs, 1, 8 - r)")
        well = _forall("allp", f"lambda p: regexp_matches(p.lhs, {_BITS8}) AND regexp_matches(p.rhs, {_BITS8})")
        bits = f"({well} AND ({xor_ok} OR {rot} OR {shl} OR {shr}))"
        mapping = (
            "flatten(list_transform(allp, lambda p: list_transform(range(1, length(p.lhs) + 1), "
            "lambda i: {'s': substr(p.lhs, i, 1), 'd': substr(p.rhs, i, 1)})))"
        )
        same_len = _forall("allp", "lambda p: length(p.lhs) = length(p.rhs)")
        cmap = f"({same_len} AND len(list_distinct({mapping})) = len(list_distinct(list_transform({mapping}, lambda m: m.s))))"
        out["v8_consistent"] = (
            f"CASE WHEN category = 'physics' THEN coalesce(({v7}) AND {ex_p}, false) "
            f"WHEN category = 'unit_conversion' THEN coalesce(({v7}) AND {ex_u}, false) "
            f"WHEN category = 'numeral_system' THEN {v4} "
            f"WHEN category = 'bit_manipulation' THEN {n} > 0 AND coalesce({bits}, false) "
            f"WHEN category IN ('text_encryption', 'symbol_transformation') THEN {n} > 0 AND coalesce({cmap}, false) END"
        )
    return out


_EVAL = "(SELECT id, prompt, answer, category FROM eval_rows)"


def _eval(spark, d):
    return QS.eval_rows(spark, d)


# --------------------------------------------------------------- queries


@query(
    "example_pairs",
    V.with_views(
        "SELECT id, CAST(pos AS BIGINT) AS pos, pairs[pos].lhs AS lhs, pairs[pos].rhs AS rhs FROM "
        f"(SELECT id, {_pairs_sql('prompt', 'category')} AS pairs FROM {_EVAL}), LATERAL (SELECT unnest(range(1, len(pairs) + 1)) AS pos)",
        "eval_rows",
    ),
)
def example_pairs(spark, d):
    """PRJ16: one row per example pair of every evaluation-set prompt."""
    e = _eval(spark, d)
    p = e.select("id", F.posexplode(VA.example_pairs(F.col("prompt"), F.col("category"))).alias("pos", "pair"))
    return p.select("id", (F.col("pos") + 1).cast("bigint").alias("pos"), F.col("pair.lhs").alias("lhs"), F.col("pair.rhs").alias("rhs"))


def _rules_sql(cols: list[str]) -> str:
    r = _rules(with_v8="v8_consistent" in cols)
    sel = ", ".join(f"{r[c]} AS {c}" for c in cols)
    return V.with_views(f"SELECT id, category, CAST(len(pairs) AS BIGINT) AS n_pairs, {sel} FROM ({_stage1(_EVAL)})", "eval_rows")


_FORMAT_COLS = ["v1_bits", "v2_text", "v2_words", "v3_numeric", "v4_numeral", "v5_symbol"]


@query("validate_format", _rules_sql(_FORMAT_COLS))
def validate_format(spark, d):
    """V1-V5 and the word list of V2: one column per format rule (null where the rule does not apply)."""
    v = VA.validation_columns(_eval(spark, d))
    return v.select("id", "category", "n_pairs", *_FORMAT_COLS)


@query("verify_consistency", _rules_sql(["v7_answer", "v8_consistent"]))
def verify_consistency(spark, d):
    """V7 + V8: recomputed answers and same-rule consistency of every puzzle."""
    v = VA.validation_columns(_eval(spark, d))
    return v.select("id", "category", "n_pairs", "v7_answer", "v8_consistent")


_NUMERIC_SRC = f"(SELECT * FROM {_EVAL} WHERE category IN ('physics', 'unit_conversion'))"


@query(
    "verify_numeric",
    V.with_views(
        "SELECT id, category, round(coef, 6) AS coefficient, round(pred, 6) AS predicted, coalesce(abs(TRY_CAST(answer AS DOUBLE) - pred) <= tol, false) AS answer_ok "
        "FROM (SELECT id, category, answer, "
        f"CASE WHEN category = 'physics' THEN {_div('sxy_p', 'sxx_p')} ELSE {_div('sxy_u', 'sxx_u')} END AS coef, "
        f"CASE WHEN category = 'physics' THEN {_div('sxy_p', 'sxx_p')} * TRY_CAST(q AS DOUBLE) * TRY_CAST(q AS DOUBLE) "
        f"ELSE {_div('sxy_u', 'sxx_u')} * TRY_CAST(q AS DOUBLE) END AS pred, "
        f"CASE WHEN category = 'physics' THEN {_tol('(TRY_CAST(q AS DOUBLE) * TRY_CAST(q AS DOUBLE))', 'p')} ELSE {_tol('TRY_CAST(q AS DOUBLE)', 'u')} END AS tol "
        f"FROM ({_stage1(_NUMERIC_SRC)}))",
        "eval_rows",
    ),
)
def verify_numeric(spark, d):
    """V7: least-squares coefficient from the examples, recomputed answer, verdict."""
    return VA.numeric_check(_eval(spark, d))


_BEFORE = S.strip("split_part(text, 'PROMPT:', 1)")
_AFTER = S.strip("split_part(text, 'ANSWER:', 2)")


@query(
    "validate_markers",
    V.with_views(
        f"SELECT id, contains(text, 'PROMPT:') AND contains(text, 'ANSWER:') AND {_BEFORE} = '' AND "
        f"len(list_filter(string_split({_AFTER}, chr(10)), lambda l: {S.strip('l')} <> '')) <= 1 AS v6_markers FROM gens",
        "gens",
    ),
)
def validate_markers(spark, d):
    """V6: no text outside the PROMPT:/ANSWER: markers of every raw generation."""
    g = V.gens(spark, d).select("id", "text", F.col("category"), F.lit("").alias("prompt"), F.lit("").alias("answer"))
    return VA.validation_columns(g, raw="text").select("id", "v6_markers")


@query(
    "duplicate_ids",
    V.with_views(
        "SELECT id, CAST(count(*) AS BIGINT) AS n FROM (SELECT CAST(problem AS VARCHAR) || '-' || CAST(sample_idx AS VARCHAR) AS id FROM votes) "
        "GROUP BY id HAVING count(*) > 1",
        "votes",
    ),
)
def duplicate_ids(spark, d):
    """AGG16: sample ids (problem-sample) that occur more than once."""
    v = V.votes(spark, d).select(F.concat_ws("-", F.col("problem").cast("string"), F.col("sample_idx").cast("string")).alias("id"))
    return VA.duplicate_ids(v, "id")


@query(
    "augment_union",
    V.with_views("SELECT id, prompt, answer, NULL AS category FROM examples UNION ALL SELECT id, prompt, answer, category FROM accepted", "examples", "accepted"),
)
def augment_union(spark, d):
    """SET1: original examples + accepted synthetic rows, union by name (missing columns null)."""
    from quarry.operators import synth as Y

    orig = V.examples(spark, d).select("id", "prompt", "answer")
    syn = Y.accepted(V.gens(spark, d))
    return orig.unionByName(syn, allowMissingColumns=True)
