"""Which 8-bit rules agree with a puzzle's pairs: a version space in numpy.

A rule is a function of up to three copies of the input, each rotated or shifted
(``TERMS``), followed by a mask that is the same for all pairs:

* one copy; then each position is kept, inverted or constant, which covers XOR,
  AND, OR and NOT with a mask;
* XOR, AND, OR, or AND with the complement, of two copies; majority, or choice
  (the first selects between the others), of three; then each position is kept or
  inverted, which covers NOT and XOR with a mask and the negated functions.

Every rule's output for all 256 inputs is one table row; a pair keeps the rows
whose output differs from its right side by the same mask as for the first pair.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, permutations

import numpy as np

X = np.arange(256, dtype=np.uint16)
TERMS = [("rotate", r) for r in range(8)] + [("left", r) for r in range(1, 8)] + [("right", r) for r in range(1, 8)]


def term(kind: str, r: int) -> np.ndarray:
    moved = {"rotate": (X << r) | (X >> (8 - r)), "left": X << r, "right": X >> r}[kind]
    return (moved & 255).astype(np.uint8)


@lru_cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Outputs of the single copies, and of all functions of two or three."""
    t = [term(*x) for x in TERMS]
    two = [f for a, b in combinations(t, 2) for f in (a ^ b, a & b, a | b, a & ~b, b & ~a)]
    three = [(a & b) | (a & c) | (b & c) for a, b, c in combinations(t, 3)]
    three += [(a & b) | (~a & c) for a, b, c in permutations(t, 3)]
    return np.array(t), np.unique(np.array(two + three, np.uint8), axis=0)


def single_copy(pairs: list[tuple[int, int]]) -> bool:
    """True if a rule of one copy maps every left side to its right side."""
    one, _ = tables()
    lhs, rhs = (np.array(x, np.uint8) for x in zip(*pairs))
    off = one[:, lhs] ^ rhs  # 1 where a position would have to be inverted
    kept, inverted = np.bitwise_and.reduce(~off, axis=1), np.bitwise_and.reduce(off, axis=1)
    constant = np.bitwise_and.reduce(rhs) | np.bitwise_and.reduce(~rhs)
    return bool(((kept | inverted | constant) == 255).any())


def consistent(pairs: list[tuple[int, int]]) -> bool:
    """True if one rule maps every left side to its right side."""
    if single_copy(pairs):
        return True
    _, more = tables()
    lhs, rhs = (np.array(x, np.uint8) for x in zip(*pairs))
    mask = more[:, lhs[0]] ^ rhs[0]
    alive = np.arange(len(more))
    for x, y in zip(lhs[1:], rhs[1:]):
        alive = alive[(more[alive, x] ^ y) == mask[alive]]
    return bool(len(alive))


def answer_follows(pairs: list[tuple[int, int]]) -> bool:
    """True if one rule maps every pair, the last of which is the answer. Where a
    rule of one copy fits the examples, the answer must follow from such a rule
    too: among the rules of two and three copies one fits many a wrong answer."""
    return single_copy(pairs) or (not single_copy(pairs[:-1]) and consistent(pairs)) if len(pairs) > 1 else True


def pairs_consistent(pairs) -> bool | None:
    """``answer_follows`` for (lhs, rhs) bit texts; False where one is not eight bits, null for null."""
    if pairs is None:
        return None
    texts = [(p["lhs"], p["rhs"]) for p in pairs]
    if not texts or any(x is None or len(x) != 8 or x.strip("01") for p in texts for x in p):
        return False
    return answer_follows([(int(a, 2), int(b, 2)) for a, b in texts])
