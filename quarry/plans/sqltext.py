"""DuckDB SQL fragments mirroring ``quarry.functions`` for the oracle queries.

Only used to build the independent ``oracle_sql()`` strings; the Spark side
never parses SQL from here.
"""

from __future__ import annotations

from quarry.functions.text import BOXED, LINEBREAKS, NON_WS, WS


def q(s: str) -> str:
    """SQL string literal (DuckDB strings take backslashes literally)."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def collapse_ws(x: str) -> str:
    return f"regexp_replace({x}, {q(WS + '+')}, ' ', 'g')"


def word_count(x: str) -> str:
    return f"CAST(coalesce(len(regexp_extract_all({x}, {q(NON_WS + '+')})), 0) AS BIGINT)"


def words(x: str) -> str:
    return f"coalesce(regexp_extract_all({x}, {q(NON_WS + '+')}), [])"


def char_length(x: str) -> str:
    return f"CAST(length(coalesce({x}, '')) AS BIGINT)"


def first_word(x: str) -> str:
    return f"regexp_extract(coalesce({x}, ''), {q(NON_WS + '+')}, 0)"


def raw_answer(x: str) -> str:
    return strip(f"coalesce({x}, '')")


def normalize_answer(x: str) -> str:
    # fixture texts are NFKC-stable, DuckDB has no NFKC
    return collapse_ws(strip(f"coalesce({x}, '')"))


def extract_final_answer(x: str) -> str:
    v = strip(f"replace(replace(replace(coalesce({x}, ''), '<|im_end|>', ''), '</s>', ''), '<eos>', '')")
    boxed = strip(f"regexp_extract({v}, {q(BOXED)}, 1)")
    lines = f"list_filter(list_transform(regexp_split_to_array({v}, {q(LINEBREAKS)}), lambda l: {strip('l')}), lambda l: l <> '')"
    return f"(CASE WHEN regexp_matches({v}, {q(BOXED)}) THEN {boxed} ELSE coalesce({lines}[1], '') END)"


def extract_tag(x: str, tag: str) -> str:
    pat = f"(?s)<{tag}>(.*?)</{tag}>"
    return f"(CASE WHEN regexp_matches({x}, {q(pat)}) THEN regexp_extract({x}, {q(pat)}, 1) END)"


def _parse_parts(x: str):
    p = strip(f"split_part(split_part({x}, 'PROMPT:', 2), 'ANSWER:', 1)")
    a = strip(f"split_part({strip(f'split_part({x}, {q("ANSWER:")}, 2)')}, chr(10), 1)")
    ok = f"(contains({x}, 'PROMPT:') AND contains({x}, 'ANSWER:') AND {p} <> '' AND {a} <> '')"
    return p, a, ok


def parse_prompt(x: str) -> str:
    p, a, ok = _parse_parts(x)
    return f"(CASE WHEN {ok} THEN {p} END)"


def parse_answer(x: str) -> str:
    p, a, ok = _parse_parts(x)
    return f"(CASE WHEN {ok} THEN {a} END)"


def hash_hex(tag: str, seed: int, *keys: str) -> str:
    parts = [q(tag), q(str(seed))] + [f"CAST({k} AS VARCHAR)" for k in keys]
    return "md5(" + " || '|' || ".join(parts) + ")"


def hex8(h: str) -> str:
    return f"CAST(('0x' || substr({h}, 1, 8)) AS BIGINT)"


def uniform_int(h: str, lo: int, hi: int) -> str:
    return f"({lo} + ({hex8(h)} % {hi - lo + 1}))"


def hundredths_text(h: str) -> str:
    return (
        f"(CAST(({h}) // 100 AS VARCHAR) || '.' || CASE WHEN ({h}) % 10 = 0 "
        f"THEN CAST((({h}) % 100) // 10 AS VARCHAR) ELSE lpad(CAST(({h}) % 100 AS VARCHAR), 2, '0') END)"
    )


def int_to_roman(n: str) -> str:
    from quarry.functions.numbers import ROMAN_HUNDREDS, ROMAN_TENS, ROMAN_UNITS

    def arr(t):
        return "[" + ", ".join(q(s) for s in t) + "]"

    n = f"greatest({n}, 0)"
    return (
        f"(repeat('M', (({n}) // 1000)::INTEGER) || {arr(ROMAN_HUNDREDS)}[(({n}) // 100) % 10 + 1] || "
        f"{arr(ROMAN_TENS)}[(({n}) // 10) % 10 + 1] || {arr(ROMAN_UNITS)}[({n}) % 10 + 1])"
    )


FRAC_LATEX = r"^\\frac\{(-?[0-9]+)\}\{(-?[0-9]+)\}$"
FRAC_PLAIN = r"^(-?[0-9]+)/(-?[0-9]+)$"
DECIMAL = r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def canonical_text(x: str) -> str:
    return normalize_answer(x)


def canonical_value(x: str) -> str:
    v = canonical_text(x)

    def frac(pat):
        num = f"TRY_CAST(regexp_extract({v}, {q(pat)}, 1) AS DOUBLE)"
        den = f"TRY_CAST(regexp_extract({v}, {q(pat)}, 2) AS DOUBLE)"
        return f"(CASE WHEN regexp_matches({v}, {q(pat)}) AND {den} <> 0 THEN {num} / {den} END)"

    return f"coalesce({frac(FRAC_LATEX)}, {frac(FRAC_PLAIN)}, CASE WHEN regexp_matches({v}, {q(DECIMAL)}) THEN TRY_CAST({v} AS DOUBLE) END)"


def answers_equivalent(a: str, b: str, tol: float = 1e-9) -> str:
    va, vb = canonical_value(a), canonical_value(b)
    return (
        f"(CASE WHEN {va} IS NOT NULL AND {vb} IS NOT NULL THEN abs({va} - {vb}) <= {tol} * greatest(1.0, abs({va})) "
        f"ELSE {canonical_text(a)} = {canonical_text(b)} END)"
    )
