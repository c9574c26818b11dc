"""Exact answer values by a table of forms; bit rules: every family right, broken, and against a plain search."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quarry.functions import bitrules as B
from quarry.functions import exact as E
from quarry.functions import text as T
from quarry.operators import validate as VA

FORMS = {
    "3/4": (3, 4), "0.75": (3, 4), r"\frac{3}{4}": (3, 4), r"\dfrac{3}{4}": (3, 4), r"\tfrac{3}{4}": (3, 4), "75%": (3, 4), r"75\%": (3, 4), "1.5/2": (3, 4), ".75": (3, 4),
    r"-\frac{1}{2}": (-1, 2), r"\frac{-1}{2}": (-1, 2), r"\frac{1}{-2}": (-1, 2), "-0.5": (-1, 2), r"$-\dfrac{1}{2}$": (-1, 2),
    "1,000": (1000, 1), "1e3": (1000, 1), "1E+3": (1000, 1), "10^3": (1000, 1), r"10^{3}": (1000, 1), r"1 \times 10^3": (1000, 1), r"1\cdot 10^{3}": (1000, 1), "1000.": (1000, 1), "1,000.00": (1000, 1),
    "+5": (5, 1), "(5)": (5, 1), "--5": (5, 1), r"\left(5\right)": (5, 1), "1 1/2": (3, 2), "-1 1/2": (-3, 2), r"1\frac{1}{2}": (3, 2), r"-2\frac{1}{4}": (-9, 4), r"1 \frac{1}{2}": (3, 2),
    r"\frac{\frac{1}{2}}{3}": (1, 6), r"\frac{1}{\frac{2}{3}}": (3, 2), r"\frac{1}{2}/3": (1, 6), r"\frac{3}{4}\%": (3, 400), "2^-2": (1, 4), "-2^2": (-4, 1), "(1/2)^2": (1, 4), "0": (0, 1), "-0": (0, 1),
    "12345678901234567890.5": (24691357802469135781, 2), "3/4.": (3, 4), "0.1": (1, 10),
}
NONE = ["", " ", "abc", "1+1", "3-2", "1/0", r"\frac{1}{0}", "1/2/2024", "1,00", "1 2", "00000101", "007", "1e99999", "2^2^", "(1", "1)", r"\frac{1}", "5 apples", "x/2", "%", "-", "1.2.3", "9" * 3000, "10^99999", "^2", "1//2", r"\frac{1}{2}{3}"]


@pytest.mark.parametrize("form", FORMS)
def test_forms(form):
    assert E.value(form) == Fraction(*FORMS[form])


@pytest.mark.parametrize("text", NONE)
def test_no_value(text):
    assert E.value(text) is None


def test_nested_fractions_against_fractions():
    r = random.Random(1)

    def made(deep):
        if deep == 0 or r.random() < 0.3:
            a = r.randrange(1, 50)
            return str(a), Fraction(a)
        (a, x), (b, y) = made(deep - 1), made(deep - 1)
        s = r.choice(["", "-"])
        return f"{s}\\frac{{{a}}}{{{b}}}", (-1 if s else 1) * x / y

    for _ in range(200):
        text, want = made(4)
        assert E.value(text) == want, text


def test_equality_is_exact(spark):
    rows = [("0.1", "0.1000000001", False), ("0.1", "1/10", True), ("0.33333333333333333333", "1/3", False), ("1,000", "1e3", True), ("yes", "Yes", False), ("yes", " yes ", True), ("12345678901234567890", "12345678901234567891", False), (None, "1", None), ("1/2", "half", False), ("00000101", "101", False), ("50%", "0.5", True)]
    df = spark.createDataFrame(rows, "a string, b string, want boolean")
    out = df.select("a", "b", "want", T.answers_equivalent("a", "b").alias("got")).collect()
    assert all(bool(x["got"]) == bool(x["want"]) for x in out), out


def rot(x, r):
    return ((x << r) | (x >> (8 - r))) & 255


FAMILIES = {
    "rotate": lambda x: rot(x, 3), "shift": lambda x: x >> 2, "xor mask": lambda x: x ^ 0b10101010, "and mask": lambda x: x & 0b11110011, "or mask": lambda x: x | 0b00010010, "not": lambda x: ~x & 255,
    "rotate then xor": lambda x: rot(x, 1) ^ 0b01100101, "xor of shifts": lambda x: (x << 1 & 255) ^ (x >> 3), "and of rotations": lambda x: rot(x, 1) & rot(x, 6), "or": lambda x: x | rot(x, 2),
    "majority": lambda x: (x & rot(x, 1)) | (x & rot(x, 2)) | (rot(x, 1) & rot(x, 2)), "choice": lambda x: (x & rot(x, 1)) | (~x & rot(x, 5)) & 255, "choice then xor": lambda x: ((x & rot(x, 3)) | (~x & (x >> 1)) & 255) ^ 0b11000011,
}


def search(pairs):
    """The same rules, one at a time, bit by bit."""
    t = [[int(v) for v in B.term(*x)] for x in B.TERMS]

    def masked(out, constants):
        for i in range(8):
            seen = {((out(a) >> i) & 1, (b >> i) & 1) for a, b in pairs}
            kept, inverted = all(x == y for x, y in seen), all(x != y for x, y in seen)
            if not (kept or inverted or constants and len({y for _, y in seen}) == 1):
                return False
        return True

    if any(masked(lambda x, a=a: a[x], True) for a in t):
        return True
    for i, a in enumerate(t):
        for j, b in enumerate(t):
            if i != j and any(masked(lambda x, f=f: f(a[x], b[x]) & 255, False) for f in (lambda p, q: p ^ q, lambda p, q: p & q, lambda p, q: p | q, lambda p, q: p & ~q)):
                return True
    for i, a in enumerate(t):
        for j, b in enumerate(t):
            for k, c in enumerate(t):
                if len({i, j, k}) == 3:
                    if i < j < k and masked(lambda x: (a[x] & b[x]) | (a[x] & c[x]) | (b[x] & c[x]), False):
                        return True
                    if masked(lambda x: (a[x] & b[x]) | (~a[x] & 255 & c[x]), False):
                        return True
    return False


@pytest.mark.parametrize("family", FAMILIES)
def test_every_family_passes_and_fails_when_broken(family):
    r = random.Random(family)
    xs = r.sample(range(256), 9)
    good = [(x, FAMILIES[family](x)) for x in xs]
    assert B.consistent(good)
    broken = 0
    for i in range(8):
        bad = [*good[:-1], (good[-1][0], good[-1][1] ^ (1 << i))]
        broken += not B.consistent(bad)
    assert broken >= 6  # a position that is constant but for one pair can also be read as a mask


def test_against_a_plain_search():
    r = random.Random(3)
    for n in (2, 3, 4):
        for _ in range(4):
            pairs = [(r.randrange(256), r.randrange(256)) for _ in range(n)]
            assert B.consistent(pairs) == search(pairs), pairs


@pytest.mark.parametrize("family", FAMILIES)
def test_answer_follows_the_simplest_rules(family):
    r = random.Random(family)
    for _ in range(20):
        good = [(x, FAMILIES[family](x)) for x in r.sample(range(256), 9)]
        assert B.answer_follows(good)
        for i in range(8):
            bad = [*good[:-1], (good[-1][0], good[-1][1] ^ (1 << i))]
            assert B.answer_follows(bad) <= B.consistent(bad)
            if B.single_copy(good[:-1]):
                assert B.answer_follows(bad) == B.single_copy(bad)


def test_rule_column(spark):
    def prompt(f):
        return "x\n" + "\n".join(f"{x:08b} -> {f(x):08b}" for x in (1, 77, 130, 200, 254, 99, 36)) + "\nNow, determine the output for: 01010101"

    rows = []
    for name, f in FAMILIES.items():
        rows.append((name, prompt(f), f"{f(0b01010101):08b}", "bit_manipulation"))
    rows += [("broken", prompt(FAMILIES["choice"]), f"{FAMILIES['choice'](0b01010101) ^ 16:08b}", "bit_manipulation"), ("short", prompt(FAMILIES["not"]), "1010", "bit_manipulation"), ("none", None, None, "bit_manipulation"), ("other", "x", "y", "text")]
    out = {x["id"]: x["v8_consistent"] for x in VA.validation_columns(spark.createDataFrame(rows, "id string, prompt string, answer string, category string")).collect()}
    assert all(out[n] for n in FAMILIES) and [out["broken"], out["short"], out["none"], out["other"]] == [False, False, False, None]
