"""Exact value of an answer: a shunting-yard reader to a reduced rational.

Read are integers, decimals and exponents of any length up to ``LONGEST`` characters, thousands marks
(``1,000``), signs, ``a/b``, nested ``\\frac`` (``\\dfrac``, ``\\tfrac``), mixed
numbers (``1 1/2``, ``1\\frac{1}{2}``), percent, powers with a whole exponent,
``\\times`` and ``\\cdot``, brackets, and math marks around all that. Sums and
differences, words and everything else are no values. Several digits that begin
with a zero, without a point, are a code (bit strings) and no value either.
"""

from __future__ import annotations

import re
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LONGEST = 2000  # characters of an answer that is read as a value
POWER = 2000  # largest exponent
DRESS = re.compile(r"\\(?:left|right|displaystyle|,|!|;|:|\(|\)|\[|\])|\$")
TOKEN = re.compile(
    r"\s*(?:(?P<number>(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d*)?(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?)"
    r"|(?P<frac>\\[dt]?frac)|(?P<times>\\times|\\cdot|\*)|(?P<percent>\\?%)|(?P<op>[-+/^(){}]))"
)
NUMERIC = r"^[-+\s\d.,eE/^(){}%*$\\]|\\d?frac"
BINDS = {"^": 5, "sign": 4, "/": 3, "*": 2, "mixed": 1}


def _number(text: str) -> Fraction:
    mantissa = re.split("[eE]", text.replace(",", ""))
    if len(mantissa[0]) > 1 and mantissa[0][0] == "0" and mantissa[0].isdigit():
        raise ValueError("a code")
    if len(mantissa) > 1 and abs(int(mantissa[1])) > POWER:
        raise ValueError("too large")
    return Fraction(text.replace(",", ""))


def _apply(op: str, values: list[Fraction]) -> None:
    if op == "sign":
        values.append(-values.pop())
        return
    b, a = values.pop(), values.pop()
    if op == "^":
        if b.denominator != 1 or abs(b) > POWER or (a.numerator.bit_length() + a.denominator.bit_length()) * abs(b) > 64 * POWER:
            raise ValueError("power")
        values.append(a ** int(b))
    elif op == "mixed":
        if a.denominator != 1 or not 0 <= b < 1:
            raise ValueError("not a mixed number")
        values.append(a + b)
    else:
        values.append(a * b if op == "*" else a / b)


def value(text: str | None) -> Fraction | None:
    """The exact value, or None."""
    if not text or len(text) > LONGEST:
        return None
    text = DRESS.sub(" ", text).strip().rstrip(".")
    values: list[Fraction] = []
    ops: list[str] = []
    operand = False  # the last token ended a value
    whole = False  # it was a whole number, which a fraction may follow

    def reduce(least: int) -> None:
        while ops and ops[-1] in BINDS and BINDS[ops[-1]] >= least:
            _apply(ops.pop(), values)

    at = 0
    try:
        while at < len(text):
            m = TOKEN.match(text, at)
            if not m:
                return None
            spaced, at = m[0][:1].isspace(), m.end()
            kind = m.lastgroup
            token = m[kind]
            if kind == "number" or kind == "frac" or token in "({":
                if operand:
                    # a value after a value: a mixed number, or the second part of a fraction
                    if ops and ops[-1] == "frac1" and token == "{":
                        ops[-1] = "frac"
                    elif whole and (kind == "frac" or kind == "number" and spaced):
                        ops.append("mixed")
                    else:
                        return None
                if kind == "number":
                    values.append(_number(token))
                    operand, whole = True, token.isdigit() and not (ops and ops[-1] in ("/", "^", "mixed"))
                elif kind == "frac":
                    ops.append("frac0")
                    operand = whole = False
                else:
                    if ops and ops[-1] == "frac0":
                        ops[-1] = "frac1"
                        ops.append("{0")
                    else:
                        ops.append(token)
                    operand = whole = False
            elif kind == "percent":
                if not operand:
                    return None
                reduce(BINDS["mixed"])
                values.append(values.pop() / 100)
                whole = False
            elif token in ")}":
                if not operand:
                    return None
                reduce(0)
                opening = ops.pop() if ops else ""
                if opening[:1] != {")": "(", "}": "{"}[token]:
                    return None
                if ops and ops[-1] == "frac":
                    ops.pop()
                    _apply("/", values)
                operand, whole = True, False
            elif token in "+-" and not operand:
                if token == "-":
                    ops.append("sign")
            elif token in "/^" or kind == "times":
                if not operand:
                    return None
                op = "*" if kind == "times" else token
                if op == "/" and ops and ops[-1] == "/":
                    return None  # dates and the like
                reduce(BINDS[op] + (op == "^"))
                ops.append(op)
                operand = whole = False
            else:
                return None
        if not operand:
            return None
        reduce(0)
        return values[0] if not ops and len(values) == 1 else None
    except (ValueError, ZeroDivisionError, IndexError):
        return None


def written(text: str | None) -> str | None:
    """``numerator/denominator`` in lowest terms."""
    v = value(text)
    return None if v is None else f"{v.numerator}/{v.denominator}"


def exact_value(text: Column) -> Column:
    """Reduced ``numerator/denominator`` of an answer that has a value, else null. Only
    answers that hold a digit and begin like a value go to Python, in Arrow batches."""

    # of plain batch functions Spark evaluates several in one Python worker; each one that
    # takes an iterator has a worker to itself in every running task
    @F.pandas_udf("string")
    def read(s: pd.Series) -> pd.Series:
        return s.map(written, na_action="ignore").astype(object)

    likely = text.rlike(NUMERIC) & text.rlike("[0-9]")
    return F.when(likely, read(F.when(likely, text)))
