"""Synthesis queries (JOB3): computed puzzles over the part table, quota over
stored generations, generation requests, category tagging, the evaluation set."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import curate as C
from quarry.operators import sampling as SM
from quarry.operators import synth as Y
from quarry.plans import sqltext as S
from quarry.plans import views as V
from quarry.plans.registry import query
from quarry.session import materialize
from quarry.sources.tables import dealt, table

SEED = 42
QUOTA = 40


def _h(kind: str, label_sql: str) -> str:
    return f"md5('{kind}|{SEED}|' || CAST(key AS VARCHAR) || '|' || {label_sql})"


def _u(kind: str, label_sql: str, lo: int, hi: int) -> str:
    return S.uniform_int(_h(kind, label_sql), lo, hi)


def _fill(template: str, **exprs: str) -> str:
    """SQL concatenation of a generator template with SQL expressions for its fields."""
    parts = []
    for lit, field in Y.template_parts(template):
        if lit:
            parts.append(S.q(lit))
        if field:
            parts.append(f"({exprs[field]})")
    return " || ".join(parts)


def _lines(head: str, lines_sql: str, tail_sql: str) -> str:
    return f"{S.q(head)} || chr(10) || array_to_string({lines_sql}, chr(10)) || chr(10) || {tail_sql}"


_PHYS_SQL = f"""
SELECT key, {_lines(Y.PHYSICS_HEAD,
    "list_transform(xs, lambda x: " + _fill(Y.PHYSICS_LINE, t=S.hundredths_text('x'), d=S.hundredths_text('(g_h * x * x + 10000) // 20000')) + ")",
    _fill(Y.PHYSICS_TAIL, t=S.hundredths_text('xq')))} AS prompt,
  {S.hundredths_text('(g_h * xq * xq + 10000) // 20000')} AS answer, 'physics' AS category
FROM (SELECT key, g_h, list_transform(range(1, n_ex + 1), lambda i: {_u('physics', "'t' || CAST(i AS VARCHAR)", *Y.T_RANGE)}) AS xs,
        {_u('physics', "'q'", *Y.T_RANGE)} AS xq
      FROM (SELECT p_partkey AS key, {_u('physics', "'g'", *Y.G_RANGE)} AS g_h, {_u('physics', "'k'", *Y.PHYS_EXAMPLES)} AS n_ex FROM part))
"""

_UNIT_SQL = f"""
SELECT key, {_lines(Y.UNIT_HEAD,
    "list_transform(xs, lambda x: " + _fill(Y.UNIT_LINE, x=S.hundredths_text('x'), y=S.hundredths_text('(x * f4 + 5000) // 10000')) + ")",
    _fill(Y.UNIT_TAIL, x=S.hundredths_text('xq')))} AS prompt,
  {S.hundredths_text('(xq * f4 + 5000) // 10000')} AS answer, 'unit_conversion' AS category
FROM (SELECT key, f4, list_transform(range(1, n_ex + 1), lambda i: {_u('unit', "'v' || CAST(i AS VARCHAR)", *Y.VALUE_RANGE)}) AS xs,
        {_u('unit', "'q'", *Y.VALUE_RANGE)} AS xq
      FROM (SELECT p_partkey AS key, {_u('unit', "'f'", *Y.FACTOR_RANGE)} AS f4, {_u('unit', "'k'", *Y.UNIT_EXAMPLES)} AS n_ex FROM part))
"""

_NUM_SQL = f"""
SELECT key, {_lines(Y.NUMERAL_HEAD,
    "list_transform(picked[1:n_ex], lambda s: " + _fill(Y.NUMERAL_LINE, n='CAST(s.n AS VARCHAR)', r=S.int_to_roman('s.n')) + ")",
    _fill(Y.NUMERAL_TAIL, n='CAST(picked[n_ex + 1].n AS VARCHAR)'))} AS prompt,
  {S.int_to_roman('picked[n_ex + 1].n')} AS answer, 'numeral_system' AS category
FROM (SELECT key, n_ex, list_sort(list_transform(range(1, {Y.NUMERAL_MAX + 1}),
        lambda n: {{'h': {_h('numeral', "'n' || CAST(n AS VARCHAR)")}, 'n': n}}))[1:n_ex + 1] AS picked
      FROM (SELECT p_partkey AS key, {_u('numeral', "'k'", *Y.NUMERAL_EXAMPLES)} AS n_ex FROM part))
"""

_PUZZLES_SQL = " UNION ALL ".join(
    f"SELECT category || '_' || CAST(key AS VARCHAR) AS id, prompt, answer, category FROM ({s})" for s in (_PHYS_SQL, _UNIT_SQL, _NUM_SQL)
)
V.register_sql_view("puzzles", [], _PUZZLES_SQL)


def _seeds(spark, d):
    """The part keys, dealt over as many tasks as their number asks for."""
    return dealt(table(spark, d, "part").select("p_partkey"))


def puzzles(spark, d):
    """Fixture view: one puzzle per part row and computed kind."""
    return Y.computed_puzzles(_seeds(spark, d), "p_partkey", SEED)


@query("synth_physics", "SELECT key AS p_partkey, prompt, answer, category FROM (" + _PHYS_SQL + ")")
def synth_physics(spark, d):
    """SYN1: one physics puzzle per part row."""
    return Y.physics(_seeds(spark, d), "p_partkey", SEED)


@query("synth_unit_conversion", "SELECT key AS p_partkey, prompt, answer, category FROM (" + _UNIT_SQL + ")")
def synth_unit_conversion(spark, d):
    """SYN2: one unit-conversion puzzle per part row."""
    return Y.unit_conversion(_seeds(spark, d), "p_partkey", SEED)


@query("synth_numeral", "SELECT key AS p_partkey, prompt, answer, category FROM (" + _NUM_SQL + ")")
def synth_numeral(spark, d):
    """SYN3: one Roman-numeral puzzle per part row."""
    return Y.numeral_system(_seeds(spark, d), "p_partkey", SEED)


_QUOTA_SQL = f"""
SELECT printf('syn_%s_%05d', substr(category, 1, 3), CAST(n - 1 AS INTEGER)) AS id, prompt, answer, category FROM (
  SELECT category, prompt, answer, row_number() OVER (PARTITION BY category ORDER BY attempt) AS n FROM (
    SELECT category, attempt, {S.parse_prompt('text')} AS prompt, {S.parse_answer('text')} AS answer FROM (
      SELECT category, text, row_number() OVER (PARTITION BY category ORDER BY conv_id, turn) AS attempt FROM gens)
    WHERE attempt <= {3 * QUOTA}) WHERE prompt IS NOT NULL) WHERE n <= {QUOTA}
"""
V.register_sql_view("quota", ["gens"], _QUOTA_SQL)


@query("quota_per_category", V.with_views("SELECT * FROM quota", "quota"))
def quota_per_category(spark, d):
    """SMP4 (+ PRJ8, FLT5, PRJ13): first 40 parseable of at most 120 attempts per category."""
    return Y.quota_per_category(V.gens(spark, d), QUOTA)


V.register_sql_view(
    "accepted",
    ["gens"],
    f"SELECT 'syn_' || substr(category, 1, 3) || '_' || id AS id, prompt, answer, category FROM (SELECT id, category, {S.parse_prompt('text')} AS prompt, {S.parse_answer('text')} AS answer FROM gens) WHERE prompt IS NOT NULL",
)


def eval_rows(spark, d):
    """The evaluation set before it is numbered: computed puzzles and every accepted
    generation (SET2), so that it grows with both tables.

    The generator at the end keeps the puzzle expressions from being copied into
    every expression that reads a prompt."""
    rows = puzzles(spark, d).unionByName(Y.accepted(V.gens(spark, d)))
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def eval_set(spark, d):
    """JOB3: the evaluation set shuffled with ``eval_%05d`` ids (SMP3, PRJ13)."""
    allrows = eval_rows(spark, d)
    # numbering reads its input twice (prefix histogram, ranked pass): generate once
    allrows = materialize(allrows)
    pos = SM.dense_positions(allrows, SEED, "id", "pos", tag="eval")
    return pos.select(F.format_string("eval_%05d", F.col("pos")).alias("id"), "prompt", "answer", "category", F.col("id").alias("source_id"))


_EVAL_SQL = (
    "SELECT printf('eval_%05d', CAST(row_number() OVER (ORDER BY " + S.hash_hex("eval", SEED, "id") + ", id) - 1 AS INTEGER)) AS id, "
    "prompt, answer, category, id AS source_id FROM eval_rows"
)
V.register_sql_view("eval_rows", ["puzzles", "accepted"], "SELECT id, prompt, answer, category FROM puzzles UNION ALL SELECT id, prompt, answer, category FROM accepted")
V.register_sql_view("eval_set", ["eval_rows"], _EVAL_SQL)


@query("eval_set", V.with_views("SELECT * FROM eval_set", "eval_set"))
def eval_set_query(spark, d):
    """JOB3: the evaluation set."""
    return eval_set(spark, d)


@query(
    "category_counts",
    V.with_views(
        "SELECT category, CAST(count(*) AS BIGINT) AS n, count(*) / (SELECT count(*) FROM eval_set) AS share FROM eval_set GROUP BY category",
        "eval_set",
    ),
)
def category_counts(spark, d):
    """AGG9 + SMP10: rows per category of the evaluation set, sorted, with shares."""
    from quarry.operators.profile import category_counts as cc

    return cc(eval_rows(spark, d), "category")


_TAG_SQL = " ".join(f"WHEN contains(prompt, {S.q(ph)}) THEN {S.q(cat)}" for cat, ph in C.CATEGORY_PHRASES)


@query(
    "category_tagging",
    V.with_views(
        f"SELECT id, CASE {_TAG_SQL} ELSE 'unknown' END AS tagged, category FROM "
        "(SELECT id, prompt, category FROM puzzles UNION ALL SELECT id, prompt, NULL AS category FROM examples)",
        "puzzles",
        "examples",
    ),
)
def category_tagging(spark, d):
    """PRJ15 over generated puzzles and the untagged examples."""
    ex = V.examples(spark, d).select("id", "prompt", F.lit(None).cast("string").alias("category"))
    rows = puzzles(spark, d).select("id", "prompt", "category").unionByName(ex)
    return rows.select("id", C.tag_category("prompt").alias("tagged"), "category")


@query(
    "generation_requests",
    V.with_views(
        "SELECT 'seed' AS kind, id AS seed_id, category, CAST(v AS BIGINT) AS variant, "
        + _fill(Y.REQUEST_TEMPLATE, category="category", variant="CAST(v AS VARCHAR)", prompt="coalesce(prompt, '')", answer="coalesce(answer, '')")
        + " AS request "
        "FROM puzzles, range(1, 6) t(v) UNION ALL SELECT 'category', NULL, category, CAST(v AS BIGINT), "
        + _fill(Y.CATEGORY_TEMPLATE, category="category", variant="CAST(v AS VARCHAR)")
        + " FROM (SELECT category, unnest(range(1, n + 1)) AS v FROM (SELECT category, count(*) AS n FROM gens GROUP BY category)) "
        "UNION ALL SELECT 'trace', id, category, NULL, " + _fill(Y.TRACE_TEMPLATE, prompt="coalesce(prompt, '')") + " FROM puzzles",
        "puzzles",
        "gens",
    ),
)
def generation_requests(spark, d):
    """SYN4: five requests per seed puzzle, one per category and stored generation, one worked answer per puzzle."""
    cols = ["kind", "seed_id", "category", "variant", "request"]
    seeds = puzzles(spark, d)
    by_seed = Y.generation_requests(seeds, 5).withColumn("kind", F.lit("seed")).select(*cols)
    counts = V.gens(spark, d).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    by_category = Y.category_requests(counts).select(F.lit("category").alias("kind"), F.lit(None).cast("string").alias("seed_id"), "category", "variant", "request")
    traces = Y.trace_requests(seeds, carry=["category"]).select(F.lit("trace").alias("kind"), "seed_id", "category", F.lit(None).cast("bigint").alias("variant"), "request")
    return by_seed.unionByName(by_category).unionByName(traces)
