"""Fixture views over the driver tables (FIXTURES.md section 2).

The reference works on prompt/answer CSVs and generation tables; the driver
tables stand in for them through these views. Each view exists twice: as a
lazy Spark DataFrame and as a DuckDB CTE for the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.plans import sqltext as S
from quarry.sources.tables import table

# Categories of the three generated-text puzzle kinds.
LLM_CATEGORIES = ["bit_manipulation", "text_encryption", "symbol_transformation"]


def examples(spark: SparkSession, d: str) -> DataFrame:
    """User turns with the assistant turn that follows (answer null if none)."""
    c = table(spark, d, "conversations")
    u = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    a = c.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return u.join(a, ["conv_id", "turn"], "left").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        "conv_id",
        "turn",
        "prompt",
        "answer",
    )


def pairs(spark: SparkSession, d: str) -> DataFrame:
    return examples(spark, d).where(F.col("answer").isNotNull())


# Gold answers and generations of the numeric shapes: equal value in another form
# (three kinds), a wrong value, and one buried in a sentence.
NUMERIC_SHAPES = {5: ("3/4", "The answer is \\boxed{0.75}."), 6: ("\\frac{1}{2}", "1/2"), 7: ("-2.5", "-2.50"), 8: ("12", "13"), 9: ("40", "it must be 40 here")}

# Well-formed puzzles of the generated kinds: prompt, right answer, broken answer.
PUZZLES = [
    ("x\n00000001 -> 00000001\n11111111 -> 00001111\n10101010 -> 00001010\nNow, determine the output for: 01010101", "00000101", "11110101"),
    ("x\nabc de -> xyz vw\nba c -> yx z\nNow, decrypt the following text: ab ed", "xy wv", "qq wv"),
    ("x\n!@#$ = ##\n%^&* = @@\nNow, determine the result for: !!##", "$$", "abc"),
]


def generations(spark: SparkSession, d: str) -> DataFrame:
    """Model outputs in ten shapes; the gold answer is the first word of the reply,
    or a number in the last five."""
    k = F.pmod(F.col("conv_id"), F.lit(10))
    gold = T.first_word("answer")
    for shape, (a, _) in NUMERIC_SHAPES.items():
        gold = F.when(k == shape, F.lit(a)).otherwise(gold)
    p = pairs(spark, d).select("id", "conv_id", gold.alias("answer"))
    lab = F.col("answer")
    raw = (
        F.when(k == 0, lab)
        .when(k == 1, F.concat(F.lit("The answer is \\boxed{"), lab, F.lit("}.")))
        .when(k == 2, F.concat(F.lit("\n\n  "), lab, F.lit("\n")))
        .when(k == 3, F.concat(lab, F.lit("<|im_end|>")))
        .otherwise(F.concat(F.lit("unclear\n"), lab))
    )
    for shape, (_, g) in NUMERIC_SHAPES.items():
        raw = F.when(k == shape, F.lit(g)).otherwise(raw)
    return p.select("id", "conv_id", "answer", raw.alias("raw_generation"))


def gens(spark: SparkSession, d: str) -> DataFrame:
    """Raw puzzle generations in eight shapes, one category per conversation; the
    last two shapes are well-formed puzzles, right and broken."""
    p = pairs(spark, d)
    k = F.pmod(F.col("conv_id"), F.lit(8))
    ci = F.pmod(F.floor(F.col("conv_id") / 8), F.lit(3)).cast("int")
    puzzle, right, broken = (F.element_at(F.array(*[F.lit(x[i]) for x in PUZZLES]), ci + 1) for i in range(3))
    pr, an = F.col("prompt"), F.col("answer")
    txt = (
        F.when(k == 0, F.concat(F.lit("PROMPT: "), pr, F.lit("\nANSWER: "), an))
        .when(k == 1, F.concat(pr, F.lit("\nANSWER: "), an))
        .when(k == 2, F.concat(F.lit("prompt: "), pr, F.lit("\nanswer: "), an))
        .when(k == 3, F.concat(F.lit("Here is one.\nPROMPT: "), pr, F.lit("\nANSWER: "), an, F.lit("\nDone.")))
        .when(k == 4, F.concat(F.lit("PROMPT: \nANSWER: "), an))
        .when(k == 5, F.concat(F.lit("PROMPT: "), pr, F.lit("\nANSWER:\n"), an))
        .otherwise(F.concat(F.lit("PROMPT: "), puzzle, F.lit("\nANSWER: "), F.when(k == 6, right).otherwise(broken)))
    )
    cat = F.element_at(F.array(*[F.lit(c) for c in LLM_CATEGORIES]), ci + 1)
    return p.select("id", "conv_id", "turn", cat.alias("category"), txt.alias("text"))


def traces(spark: SparkSession, d: str) -> DataFrame:
    """Traced responses; the tags are missing on a quarter of them."""
    doc = table(spark, d, "documents")
    wrapped = F.concat(F.lit("<think>\n"), F.col("text"), F.lit("\n</think>\n<answer>"), F.col("lang"), F.lit("</answer>"))
    return doc.select("doc_id", F.when(F.pmod("doc_id", F.lit(4)) == 3, F.col("text")).otherwise(wrapped).alias("response"))


def votes(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("problem"),
        F.col("l_linenumber").cast("bigint").alias("sample_idx"),
        F.col("l_returnflag").alias("answer"),
        F.col("l_extendedprice").alias("score"),
    )


def answer_forms(spark: SparkSession, d: str) -> DataFrame:
    """Votes whose answers are quarters of a quantity, each written in one of eight forms."""
    li = table(spark, d, "lineitem")
    q = F.col("l_quantity").cast("bigint") % 8
    text, whole, rest = q.cast("string"), F.floor(q / 4).cast("string"), (q % 4).cast("string")
    forms = [
        F.format_string("%.2f", q / 4),
        F.concat(text, F.lit("/4")),
        F.concat(F.lit("\\frac{"), text, F.lit("}{4}")),
        F.concat((q * 25).cast("string"), F.lit("%")),
        F.when((q > 4) & (q % 4 > 0), F.concat(whole, F.lit(" "), rest, F.lit("/4"))).otherwise(F.concat(text, F.lit("/4"))),
        F.concat(F.lit("$\\dfrac{"), text, F.lit("}{4}$")),
        F.concat((q * 250).cast("string"), F.lit("/1,000")),
        F.concat((q * 25).cast("string"), F.lit("e-2")),
    ]
    return li.select(
        F.col("l_orderkey").alias("problem"),
        F.col("l_linenumber").cast("bigint").alias("sample_idx"),
        F.element_at(F.array(*forms), (F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(8)) + 1).cast("int")).alias("answer"),
    )


def batches(spark: SparkSession, d: str) -> DataFrame:
    doc = table(spark, d, "documents").select("doc_id", "source")
    lab = table(spark, d, "labels").select("doc_id", "quality")
    # a document without a label has no defect value; its batch is known all the same
    return doc.join(lab, "doc_id", "left").select("doc_id", F.col("source").alias("batch"), (1 - F.col("quality")).alias("defect"))


# ---------------------------------------------------------------- SQL side

_LLM_ARR = "[" + ", ".join(S.q(c) for c in LLM_CATEGORIES) + "]"

def _puzzle_sql(part: int) -> str:
    return "[" + ", ".join(S.q(p[part]) for p in PUZZLES) + "][(conv_id // 8) % 3 + 1]"


VIEW_SQL = {
    "examples": (
        [],
        "SELECT CAST(u.conv_id AS VARCHAR) || '-' || CAST(u.turn AS VARCHAR) AS id, u.conv_id, u.turn, "
        "u.text AS prompt, a.text AS answer FROM conversations u LEFT JOIN conversations a "
        "ON a.role = 'assistant' AND a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user'",
    ),
    "pairs": (["examples"], "SELECT * FROM examples WHERE answer IS NOT NULL"),
    "generations": (
        ["pairs"],
        "SELECT id, conv_id, answer, CASE conv_id % 10 WHEN 0 THEN answer "
        "WHEN 1 THEN 'The answer is \\boxed{' || answer || '}.' "
        "WHEN 2 THEN chr(10) || chr(10) || '  ' || answer || chr(10) "
        "WHEN 3 THEN answer || '<|im_end|>' WHEN 4 THEN 'unclear' || chr(10) || answer "
        + " ".join(f"WHEN {k} THEN {S.q(g)}" for k, (_, g) in NUMERIC_SHAPES.items())
        + " END AS raw_generation FROM (SELECT id, conv_id, CASE conv_id % 10 "
        + " ".join(f"WHEN {k} THEN {S.q(a)}" for k, (a, _) in NUMERIC_SHAPES.items())
        + f" ELSE {S.first_word('answer')} END AS answer FROM pairs)",
    ),
    "gens": (
        ["pairs"],
        "SELECT id, conv_id, turn, " + _LLM_ARR + "[(conv_id // 8) % 3 + 1] AS category, CASE conv_id % 8 "
        "WHEN 0 THEN 'PROMPT: ' || prompt || chr(10) || 'ANSWER: ' || answer "
        "WHEN 1 THEN prompt || chr(10) || 'ANSWER: ' || answer "
        "WHEN 2 THEN 'prompt: ' || prompt || chr(10) || 'answer: ' || answer "
        "WHEN 3 THEN 'Here is one.' || chr(10) || 'PROMPT: ' || prompt || chr(10) || 'ANSWER: ' || answer || chr(10) || 'Done.' "
        "WHEN 4 THEN 'PROMPT: ' || chr(10) || 'ANSWER: ' || answer "
        "WHEN 5 THEN 'PROMPT: ' || prompt || chr(10) || 'ANSWER:' || chr(10) || answer "
        "ELSE 'PROMPT: ' || " + _puzzle_sql(0) + " || chr(10) || 'ANSWER: ' || CASE conv_id % 8 WHEN 6 THEN " + _puzzle_sql(1) + " ELSE " + _puzzle_sql(2) + " END END AS text FROM pairs",
    ),
    "traces": (
        [],
        "SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN text ELSE '<think>' || chr(10) || text || chr(10) || "
        "'</think>' || chr(10) || '<answer>' || lang || '</answer>' END AS response FROM documents",
    ),
    "votes": (
        [],
        "SELECT l_orderkey AS problem, CAST(l_linenumber AS BIGINT) AS sample_idx, l_returnflag AS answer, "
        "l_extendedprice AS score FROM lineitem",
    ),
    "answer_forms": (
        [],
        "SELECT problem, sample_idx, q, CASE f WHEN 0 THEN printf('%.2f', q / 4) WHEN 1 THEN q || '/4' WHEN 2 THEN '\\frac{' || q || '}{4}' WHEN 3 THEN (q * 25) || '%' "
        "WHEN 4 THEN CASE WHEN q > 4 THEN (q // 4) || ' ' || (q % 4) || '/4' ELSE q || '/4' END WHEN 5 THEN '$\\dfrac{' || q || '}{4}$' "
        "WHEN 6 THEN (q * 250) || '/1,000' ELSE (q * 25) || 'e-2' END AS answer FROM "
        "(SELECT l_orderkey AS problem, CAST(l_linenumber AS BIGINT) AS sample_idx, CAST(l_quantity AS BIGINT) % 8 AS q, (l_orderkey + l_linenumber) % 8 AS f FROM lineitem)",
    ),
    "batches": (
        [],
        "SELECT d.doc_id, d.source AS batch, 1 - l.quality AS defect FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    ),
}


def register_sql_view(name: str, deps: list[str], body: str) -> None:
    VIEW_SQL[name] = (deps, body)


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs of ``names`` and their dependencies."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for dep in VIEW_SQL[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({VIEW_SQL[n][1]})" for n in order) + "\n" + sql
