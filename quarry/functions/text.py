"""Column expressions for prompt / answer text.

Every function takes and returns ``pyspark.sql.Column`` so it composes inside
one projection and stays in whole-stage codegen. Regex classes are written in
the subset of syntax that both Java regex (Spark) and RE2 (the DuckDB oracle)
accept, so the oracle SQL can reuse the same pattern strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.exact import exact_value

# The characters Python's str.isspace() / str.split() treat as
# whitespace (Java's \s misses most of them, Spark's trim strips only U+0020).
WS_CLASS = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS = "[" + WS_CLASS + "]"
# The same 29 characters as a plain set (for trimming without a regex scan).
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"
NON_WS = "[^" + WS_CLASS + "]"
# The line boundaries of Python's str.splitlines().
LINEBREAKS = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x85\x{2028}\x{2029}]"

# End-of-turn markers removed before answer extraction, in order.
END_MARKERS = ("<|im_end|>", "</s>", "<eos>")
BOXED = r"\\boxed\{([^{}]+)\}"

# The built-in chat template.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Higher-order functions that reference an expensive expression (a word
    array, a regex result) would otherwise re-evaluate it per element when the
    optimizer inlines projections, e.g. after pushing a filter down."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(x) -> Column:
    """Python ``str.strip()``: remove leading / trailing Unicode whitespace
    (a character-set trim: only the two ends are scanned, no regex)."""
    return F.trim(_c(x), F.lit(WS_CHARS))


def collapse_ws(x) -> Column:
    """Replace every whitespace run by one space."""
    return F.regexp_replace(_c(x), WS + "+", " ")


def word_count(x) -> Column:
    """``len(str(x).split())`` with null -> 0, as BIGINT."""
    return F.coalesce(F.regexp_count(_c(x), F.lit(NON_WS + "+")), F.lit(0)).cast("bigint")


def words(x) -> Column:
    """Whitespace-split words of ``x`` (empty array for null / blank)."""
    return F.filter(F.split(strip(F.coalesce(_c(x), F.lit(""))), WS + "+"), lambda w: w != "")


def char_length(x) -> Column:
    """Code-point length with null counted as 0, as BIGINT."""
    return F.length(F.coalesce(_c(x), F.lit(""))).cast("bigint")


def token_estimate(x) -> Column:
    """Characters / 4 as an unrounded DOUBLE."""
    return char_length(x) / F.lit(4.0)


def first_word(x) -> Column:
    return F.regexp_extract(F.coalesce(_c(x), F.lit("")), NON_WS + "+", 0)


def raw_answer(x) -> Column:
    """null -> '' then strip."""
    return strip(F.coalesce(_c(x), F.lit("")))


def normalize_answer(x, nfkc: bool = True) -> Column:
    """null -> '', NFKC, strip, collapse whitespace runs to one space."""
    v = F.coalesce(_c(x), F.lit(""))
    if nfkc:
        from quarry.functions.nfkc import nfkc_column

        v = nfkc_column(v)
    return collapse_ws(strip(v))


def remove_end_markers(x) -> Column:
    v = F.coalesce(_c(x), F.lit(""))
    for m in END_MARKERS:
        v = F.replace(v, F.lit(m), F.lit(""))
    return v


def extract_final_answer(x) -> Column:
    """Final answer of a generation: the first ``\\boxed{..}`` group (stripped),
    else the first non-blank line (stripped), else ''."""
    v = strip(remove_end_markers(x))
    boxed = strip(F.regexp_extract(v, BOXED, 1))
    lines = F.filter(F.transform(F.split(v, LINEBREAKS), lambda line: strip(line)), lambda line: line != "")
    first_line = F.coalesce(F.try_element_at(lines, F.lit(1)), F.lit(""))
    return F.when(v.rlike(BOXED), boxed).otherwise(first_line)


def extract_tag(x, tag: str) -> Column:
    """Content of the first ``<tag>..</tag>`` (dot matches newline); null when absent."""
    pat = "(?s)<" + tag + ">(.*?)</" + tag + ">"
    # one regex pass: the first match of all matches, null when there is none
    return F.try_element_at(F.regexp_extract_all(_c(x), F.lit(pat), 1), F.lit(1))


def parse_prompt(x) -> Column:
    """Prompt part of a ``PROMPT: .. ANSWER: ..`` generation (null unless both parse)."""
    c = _c(x)
    p = strip(F.split_part(F.split_part(c, F.lit("PROMPT:"), F.lit(2)), F.lit("ANSWER:"), F.lit(1)))
    a = parse_answer_raw(c)
    ok = c.contains("PROMPT:") & c.contains("ANSWER:") & (p != "") & (a != "")
    return F.when(ok, p)


def parse_answer_raw(c: Column) -> Column:
    return strip(F.split_part(strip(F.split_part(c, F.lit("ANSWER:"), F.lit(2))), F.lit("\n"), F.lit(1)))


def parse_answer(x) -> Column:
    c = _c(x)
    p = strip(F.split_part(F.split_part(c, F.lit("PROMPT:"), F.lit(2)), F.lit("ANSWER:"), F.lit(1)))
    a = parse_answer_raw(c)
    ok = c.contains("PROMPT:") & c.contains("ANSWER:") & (p != "") & (a != "")
    return F.when(ok, a)


def render_training_text(prompt, answer) -> Column:
    """Built-in chat template with the assistant turn; a null answer is an error."""
    p, a = _c(prompt), _c(answer)
    text = F.concat(
        F.lit(IM_START + "user\n"), p, F.lit(IM_END + "\n" + IM_START + "assistant\n"), a, F.lit(IM_END)
    )
    return F.when(a.isNull(), F.raise_error(F.lit("a row for training has no answer"))).otherwise(text)


def render_generation_prompt(prompt) -> Column:
    return F.concat(F.lit(IM_START + "user\n"), _c(prompt), F.lit(IM_END + "\n" + IM_START + "assistant\n"))


def preview(x, n: int = 200) -> Column:
    return F.substring(_c(x), 1, n)


def truncate_to_budget(x, budget_tokens: int = 2048, chars_per_token: int = 4) -> Column:
    """Keep the first ``budget * chars_per_token`` characters (the chars/4 estimate)."""
    return F.substring(_c(x), 1, budget_tokens * chars_per_token)


def format_id(prefix: str, n) -> Column:
    """``f"{prefix}{n:05d}"`` (never truncates above 99999)."""
    return F.format_string(prefix + "%05d", _c(n))


# Canonical answer values: \frac{a}{b}, a/b and decimals compare equal.
FRAC_LATEX = r"^\\frac\{(-?[0-9]+)\}\{(-?[0-9]+)\}$"
FRAC_PLAIN = r"^(-?[0-9]+)/(-?[0-9]+)$"
DECIMAL = r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def canonical_text(x) -> Column:
    """Normalised answer text, the one that exact match compares."""
    return normalize_answer(x)


def canonical_value(x) -> Column:
    """Numeric value of ``\\frac{a}{b}``, ``a/b`` or a decimal answer, else null.
    Fractions with a zero denominator stay non-numeric."""
    v = canonical_text(x)

    def frac(pat):
        num = F.regexp_extract(v, pat, 1).try_cast("double")
        den = F.regexp_extract(v, pat, 2).try_cast("double")
        return F.when(v.rlike(pat) & (den != 0), num / den)

    return F.coalesce(frac(FRAC_LATEX), frac(FRAC_PLAIN), F.when(v.rlike(DECIMAL), v.try_cast("double")))


def answers_equivalent(a, b) -> Column:
    """Format-tolerant equality: the same exact value (``functions.exact``) when both
    have one, else equal canonical text."""
    ta, tb = canonical_text(a), canonical_text(b)
    va, vb = exact_value(ta), exact_value(tb)
    return F.when(va.isNotNull() & vb.isNotNull(), va == vb).otherwise(ta == tb)
