"""Number text and numeral expressions built from integers (never from doubles).

Doubles as text differ between engines (Spark prints 1.0E7), and Spark rounds
half-up where Python rounds the binary value, so generated numbers are kept as
integer hundredths and rendered with Python's ``str(float)`` shape.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hundredths_text(h) -> Column:
    """Text of ``h/100`` as Python's ``str(round(x, 2))`` prints it:
    ``10000 -> '100.0'``, ``15460 -> '154.6'``, ``15462 -> '154.62'``, ``7 -> '0.07'``.
    Non-negative inputs."""
    h = F.col(h) if isinstance(h, str) else h
    ip = F.floor(h / 100).cast("bigint")
    frac = F.pmod(h, F.lit(100)).cast("bigint")
    tail = F.when(F.pmod(frac, F.lit(10)) == 0, (frac / 10).cast("bigint").cast("string")).otherwise(
        F.lpad(frac.cast("string"), 2, "0")
    )
    return F.concat(ip.cast("string"), F.lit("."), tail)


def div_round_half_up(num: Column, den: int) -> Column:
    """round(num / den) half-up for non-negative integers, as BIGINT."""
    return F.floor((num + F.lit(den // 2)) / F.lit(den)).cast("bigint")


# Roman numeral digits per decimal place (units, tens, hundreds, thousands).
ROMAN_UNITS = ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"]
ROMAN_TENS = ["", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC"]
ROMAN_HUNDREDS = ["", "C", "CC", "CCC", "CD", "D", "DC", "DCC", "DCCC", "CM"]
ROMAN_THOUSAND = "M"


def _digit(n: Column, place: int) -> Column:
    return F.pmod(F.floor(n / F.lit(place)), F.lit(10)).cast("int")


def int_to_roman(n) -> Column:
    """Roman numeral; per decimal place, which equals greedy subtraction. ``M``
    repeats without limit; zero and negative numbers give ''."""
    n = F.col(n) if isinstance(n, str) else n

    def pick(table, idx):
        return F.try_element_at(F.array(*[F.lit(s) for s in table]), idx + 1)

    n = F.greatest(n, F.lit(0))
    thousands = F.floor(n / F.lit(1000)).try_cast("int")
    return F.concat(
        F.repeat(F.lit(ROMAN_THOUSAND), thousands),
        pick(ROMAN_HUNDREDS, _digit(n, 100)),
        pick(ROMAN_TENS, _digit(n, 10)),
        pick(ROMAN_UNITS, _digit(n, 1)),
    )
