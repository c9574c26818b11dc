"""Puzzle synthesis as Spark jobs (SYN1-SYN4) and the generation quota (SMP4).

Generators take a table of seed keys (one puzzle per key) and derive every
random draw from md5('kind|seed|key|draw'), so output is identical under any
partitioning and grows with the seed table. Numbers are integers in
hundredths (or ten-thousandths for the conversion factor); answers are
rounded half-up in exact integer arithmetic and printed as Python prints a
float.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import numbers as N
from quarry.functions import text as T
from quarry.functions.hashing import uniform_int

# Prompt lines of the three computed puzzle kinds ({name} is
# filled per puzzle; lines are joined with a newline: head, examples, tail).
PHYSICS_HEAD = "In Alice's Wonderland, the gravitational constant has been secretly changed. Here are some example observations:"
PHYSICS_LINE = "For t = {t}s, distance = {d} m"
PHYSICS_TAIL = "Now, determine the falling distance for t = {t}s given d = 0.5*g*t^2."
UNIT_HEAD = "In Alice's Wonderland, a secret unit conversion is applied to measurements. For example:"
UNIT_LINE = "{x} m becomes {y}"
UNIT_TAIL = "Now, convert the following measurement: {x} m"
NUMERAL_HEAD = "In Alice's Wonderland, numbers are secretly converted into a different numeral system. Some examples are given below:"
NUMERAL_LINE = "{n} -> {r}"
NUMERAL_TAIL = "Now, write the number {n} in the Wonderland numeral system."

_FIELD = re.compile(r"\{(\w+)\}")


def template_parts(template: str) -> list[tuple[str, str | None]]:
    """Split a template into (literal, field-or-None) pieces in order."""
    out, pos = [], 0
    for m in _FIELD.finditer(template):
        out.append((template[pos : m.start()], m.group(1)))
        pos = m.end()
    out.append((template[pos:], None))
    return out


def fill(template: str, **values: Column) -> Column:
    """The template as a string column, each {name} replaced by ``values[name]``."""
    cols = []
    for lit, field in template_parts(template):
        if lit:
            cols.append(F.lit(lit))
        if field:
            cols.append(values[field])
    return F.concat(*cols)

# Parameter ranges (hundredths unless noted).
G_RANGE = (500, 2000)  # g in 5.00..20.00
T_RANGE = (100, 500)  # t in 1.00..5.00
FACTOR_RANGE = (3000, 35000)  # factor in 0.3000..3.5000 (ten-thousandths)
VALUE_RANGE = (500, 6000)  # value in 5.00..60.00
PHYS_EXAMPLES = (3, 6)
UNIT_EXAMPLES = (3, 6)
NUMERAL_EXAMPLES = (4, 6)
NUMERAL_MAX = 100


def _draw(kind: str, seed: int, key: Column, label) -> Column:
    lab = label if isinstance(label, Column) else F.lit(str(label))
    return F.md5(F.concat_ws("|", F.lit(kind), F.lit(str(seed)), key.cast("string"), lab.cast("string")))


def _indexed(prefix: str, i: Column) -> Column:
    return F.concat(F.lit(prefix), i.cast("string"))


def _prompt(head: str, lines: Column, tail: Column) -> Column:
    return F.concat_ws("\n", F.lit(head), F.array_join(lines, "\n"), tail)


def physics(seeds: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """SYN1: d = 0.5 * g * t^2 puzzles; columns key, prompt, answer, category, plus
    the drawn numbers (g_h, examples, tq_h, answer_h) for verification."""
    k = F.col(key)
    g_h = uniform_int(_draw("physics", seed, k, "g"), *G_RANGE)
    n_ex = uniform_int(_draw("physics", seed, k, "k"), *PHYS_EXAMPLES)
    df = seeds.select(k.alias(key), g_h.alias("g_h"), n_ex.alias("n_ex"))

    def dist(t):
        return N.div_round_half_up(F.col("g_h") * t * t, 20000)

    ex = F.transform(
        F.sequence(F.lit(1), F.col("n_ex").cast("int")),
        lambda i: F.struct(uniform_int(_draw("physics", seed, F.col(key), _indexed("t", i)), *T_RANGE).alias("x")),
    )
    df = df.withColumn("examples", F.transform(ex, lambda e: F.struct(e["x"].alias("x"), dist(e["x"]).alias("y"))))
    df = df.withColumn("xq", uniform_int(_draw("physics", seed, F.col(key), "q"), *T_RANGE)).withColumn("answer_h", dist(F.col("xq")))
    lines = F.transform(
        F.col("examples"),
        lambda e: fill(PHYSICS_LINE, t=N.hundredths_text(e["x"]), d=N.hundredths_text(e["y"])),
    )
    tail = fill(PHYSICS_TAIL, t=N.hundredths_text(F.col("xq")))
    return df.select(
        key,
        _prompt(PHYSICS_HEAD, lines, tail).alias("prompt"),
        N.hundredths_text(F.col("answer_h")).alias("answer"),
        F.lit("physics").alias("category"),
    )


def unit_conversion(seeds: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """SYN2: y = x * factor puzzles."""
    k = F.col(key)
    f4 = uniform_int(_draw("unit", seed, k, "f"), *FACTOR_RANGE)
    n_ex = uniform_int(_draw("unit", seed, k, "k"), *UNIT_EXAMPLES)
    df = seeds.select(k.alias(key), f4.alias("f4"), n_ex.alias("n_ex"))

    def conv(v):
        return N.div_round_half_up(v * F.col("f4"), 10000)

    ex = F.transform(
        F.sequence(F.lit(1), F.col("n_ex").cast("int")),
        lambda i: F.struct(uniform_int(_draw("unit", seed, F.col(key), _indexed("v", i)), *VALUE_RANGE).alias("x")),
    )
    df = df.withColumn("examples", F.transform(ex, lambda e: F.struct(e["x"].alias("x"), conv(e["x"]).alias("y"))))
    df = df.withColumn("xq", uniform_int(_draw("unit", seed, F.col(key), "q"), *VALUE_RANGE)).withColumn("answer_h", conv(F.col("xq")))
    lines = F.transform(F.col("examples"), lambda e: fill(UNIT_LINE, x=N.hundredths_text(e["x"]), y=N.hundredths_text(e["y"])))
    tail = fill(UNIT_TAIL, x=N.hundredths_text(F.col("xq")))
    return df.select(
        key,
        _prompt(UNIT_HEAD, lines, tail).alias("prompt"),
        N.hundredths_text(F.col("answer_h")).alias("answer"),
        F.lit("unit_conversion").alias("category"),
    )


def numeral_system(seeds: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """SYN3: Roman numeral puzzles; 4-6 distinct example numbers in 1..100 and a
    question number not among them (first k+1 of a seeded ranking of 1..100)."""
    k = F.col(key)
    n_ex = uniform_int(_draw("numeral", seed, k, "k"), *NUMERAL_EXAMPLES)
    # the text of a draw up to its number is made once a row, and the order is the built-in one:
    # a comparator written as an expression costs more than the hundred hashes
    begin = F.concat_ws("|", F.lit("numeral"), F.lit(str(seed)), k.cast("string"), F.lit("n"))
    ranked = F.sort_array(
        T.let(begin, lambda b: F.transform(F.sequence(F.lit(1), F.lit(NUMERAL_MAX)), lambda n: F.struct(F.md5(F.concat(b, n.cast("string"))).alias("h"), n.alias("n"))))
    )
    df = seeds.select(k.alias(key), n_ex.alias("n_ex"), F.slice(ranked, 1, n_ex.cast("int") + 1).alias("picked"))
    df = df.withColumn("nums", F.transform(F.slice(F.col("picked"), 1, F.col("n_ex").cast("int")), lambda s: s["n"]))
    df = df.withColumn("nq", F.element_at(F.col("picked"), (F.col("n_ex") + 1).cast("int"))["n"])
    lines = F.transform(F.col("nums"), lambda n: fill(NUMERAL_LINE, n=n.cast("string"), r=N.int_to_roman(n)))
    tail = fill(NUMERAL_TAIL, n=F.col("nq").cast("string"))
    return df.select(
        key,
        _prompt(NUMERAL_HEAD, lines, tail).alias("prompt"),
        N.int_to_roman(F.col("nq")).alias("answer"),
        F.lit("numeral_system").alias("category"),
    )


def computed_puzzles(seeds: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """SET2: the three computed kinds appended (union by name), ids ``<kind>_<key>``."""
    out = None
    for fn in (physics, unit_conversion, numeral_system):
        p = fn(seeds, key, seed)
        p = p.select(F.concat_ws("_", F.col("category"), F.col(key).cast("string")).alias("id"), "prompt", "answer", "category")
        out = p if out is None else out.unionByName(p)
    return out


def quota_per_category(gens: DataFrame, count: int, category: str = "category", order=("conv_id", "turn"), text: str = "text", attempts: int = 3, salts: int = 256) -> DataFrame:
    """SMP4: per category, look at the first ``attempts * count`` attempts (in
    ``order``), parse them, keep the first ``count`` that parse. Ids are
    ``syn_<first 3 letters>_<n:05d>`` in acceptance order.

    A category that holds most of the attempts is ranked in ``salts`` parts first;
    the first rows of each part (``salts * attempts * count`` at most, whatever
    the table's size) are then ranked together."""
    limit, by = attempts * count, [F.col(c) for c in order]
    salted = gens.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)))
    parts = Window.partitionBy(category, "_salt").orderBy(*by)
    some = salted.withColumn("_in", F.row_number().over(parts)).where(F.col("_in") <= limit).drop("_in", "_salt")
    w = Window.partitionBy(category).orderBy(*by)
    first = some.withColumn("_attempt", F.row_number().over(w)).where(F.col("_attempt") <= limit)
    parsed = first.select(
        category, "_attempt", T.parse_prompt(text).alias("prompt"), T.parse_answer(text).alias("answer")
    ).where(F.col("prompt").isNotNull())
    w2 = Window.partitionBy(category).orderBy("_attempt")
    acc = parsed.withColumn("_n", F.row_number().over(w2)).where(F.col("_n") <= count)
    rid = F.format_string("syn_%s_%05d", F.substring(F.col(category), 1, 3), (F.col("_n") - 1).cast("int"))
    return acc.select(rid.alias("id"), "prompt", "answer", category)


def accepted(gens: DataFrame, id_col: str = "id", category: str = "category", text: str = "text") -> DataFrame:
    """Every generation that parses, without a quota; ids ``syn_<first 3 letters>_<id>``. Row by row."""
    parsed = gens.select(F.concat_ws("_", F.lit("syn"), F.substring(F.col(category), 1, 3), F.col(id_col).cast("string")).alias("id"), T.parse_prompt(text).alias("prompt"), T.parse_answer(text).alias("answer"), category)
    return parsed.where(F.col("prompt").isNotNull())


# Generation requests (SYN4): our own wording of the request, one per seed
# example and variant; the model call itself is not part of this engine.
REQUEST_TEMPLATE = (
    "Write one new puzzle of the category {category} in the same style as the example below. "
    "Reply with exactly two parts, 'PROMPT:' followed by the puzzle and 'ANSWER:' followed by the answer, "
    "and nothing else. Variant {variant}.\n\nExample:\n{prompt}\nAnswer: {answer}"
)


def generation_requests(seeds: DataFrame, variants: int = 5, id_col: str = "id", category: str = "category") -> DataFrame:
    """SYN4: ``variants`` request texts per seed example."""
    v = seeds.select(id_col, category, "prompt", "answer", F.explode(F.sequence(F.lit(1), F.lit(variants))).alias("variant"))
    req = fill(
        REQUEST_TEMPLATE,
        category=F.col(category),
        variant=F.col("variant").cast("string"),
        prompt=F.coalesce(F.col("prompt"), F.lit("")),
        answer=F.coalesce(F.col("answer"), F.lit("")),
    )
    return v.select(F.col(id_col).alias("seed_id"), category, F.col("variant").cast("bigint").alias("variant"), req.alias("request"))


CATEGORY_TEMPLATE = (
    "Invent a puzzle of the category {category} that nobody has seen before, number {variant}. State its rule by examples only. "
    "Reply with exactly two parts, 'PROMPT:' followed by the puzzle and 'ANSWER:' followed by the answer, and nothing else."
)
TRACE_TEMPLATE = (
    "Work out the problem below step by step. Put the steps between <think> and </think> and the final answer "
    "between <answer> and </answer>.\n\nProblem:\n{prompt}"
)


def category_requests(counts: DataFrame, category: str = "category", n: str = "n") -> DataFrame:
    """SYN4: as many requests per category as its count says, numbered from 1; none for a null or zero count."""
    v = counts.where(F.col(n) > 0).select(category, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(n).cast("bigint"))).alias("variant"))
    return v.select(category, "variant", fill(CATEGORY_TEMPLATE, category=F.col(category), variant=F.col("variant").cast("string")).alias("request"))


def trace_requests(problems: DataFrame, id_col: str = "id", prompt: str = "prompt", carry=()) -> DataFrame:
    """SYN4: one request for a worked answer per problem, with the ``carry`` columns."""
    return problems.select(F.col(id_col).alias("seed_id"), *carry, fill(TRACE_TEMPLATE, prompt=F.coalesce(F.col(prompt), F.lit(""))).alias("request"))
