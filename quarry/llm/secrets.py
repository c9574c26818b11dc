"""Secret scan: fixed patterns, and a guess-cost estimate for values in a credential context.

Base spans come from three patterns. Beyond those, a value named as a
credential in any of more ways (``CONTEXT``) is cut into words, dates, repeats,
sequences, keyboard walks and brute-force spans so that an attacker would need
the fewest guesses (dynamic programming over its characters); a value that
needs at least 10^``min_guesses`` is a span of kind ``guess``, unless it lies
inside a base span. Words rank by their place in a public vocabulary (a path;
read by the driver and broadcast).

A regular expression in the JVM first finds the texts that can hold a span at
all; only those go to Python. Null and empty texts have no spans, an empty table
no rows. Repeated rows get equal results, a null doc_id stays null. Texts are
read whole, values too: the segmentation stops early only where its cost has
passed ``min_guesses``. Spans that tie in their start keep the order of the
kinds. Of the input only ``doc_id`` and ``text`` are read, so no other column can
clash. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import base64
import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import read
from quarry.llm.registry import query

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CONTEXT = re.compile(
    r"""(?:password|passwd|passphrase|passcode|pwd|pass|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credentials?|bearer)["'`]?(?:\x20*(?::=|=>|->|[:=])\x20*|\x20+is\x20+)["'`]?([^\s"'`<>]{6,})""", re.I | re.A
)
# A text without any of these holds no span.
TRIGGER = r"(?i)(?:pass(?:word|wd|phrase|code|)|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credentials?|bearer)[\"'`]?(?: *[:=-]| +is )|(?-i:AKIA[A-Z0-9])|(?-i:[0-9a-f]{24})"
KINDS = ["assign", "access", "hex"]
MIN_GUESSES = 8.0  # powers of ten
KEYBOARD = ["`1234567890-=", "\tqwertyuiop[]\\", "\0asdfghjkl;'", "\0zxcvbnm,./"]
LEET = str.maketrans("4@831!0$57", "aabeiiosst")


def _neighbours() -> set[tuple[str, str]]:
    at = {c: (r, i) for r, row in enumerate(KEYBOARD) for i, c in enumerate(row) if c.strip("\0\t")}
    return {(a, b) for a, (r, i) in at.items() for b, (s, j) in at.items() if a != b and ((r == s and abs(i - j) == 1) or (s - r == 1 and j - i in (0, -1)) or (r - s == 1 and j - i in (0, 1)))}


NEXT_KEYS = _neighbours()
LOG = [0.0] + [math.log10(n) for n in range(1, 100_001)]


def _log(n: int) -> float:
    return LOG[n] if n < len(LOG) else math.log10(n)


def load_words(path: str = VOCABULARY) -> dict[str, int]:
    """Lower-case words of three letters or more, by rank: the vocabulary's order."""
    words: dict[str, int] = {}
    with open(path, "rb") as f:
        for line in f:
            piece = base64.b64decode(line.split()[0])
            if piece[:1] == b" " and len(piece) > 3 and piece[1:].isalpha():
                words.setdefault(piece[1:].decode("ascii", "ignore").lower(), len(words) + 1)
    return words


YEAR = re.compile(r"(?:19|20)\d\d", re.A)
DATES = [
    re.compile(p, re.A)
    for p in (r"(0[1-9]|[12]\d|3[01])([-/.]?)(0[1-9]|1[0-2])\2(?:19|20)\d\d", r"(0[1-9]|1[0-2])([-/.]?)(0[1-9]|[12]\d|3[01])\2(?:19|20)\d\d", r"(?:19|20)\d\d([-/.]?)(0[1-9]|1[0-2])\1(0[1-9]|[12]\d|3[01])")
]


def _dates(v: str, i: int):
    """Ends and costs of years and dates that start at i."""
    if m := YEAR.match(v, i):
        yield m.end(), _log(200)
    for p in DATES:
        if m := p.match(v, i):
            yield m.end(), _log(372) + _log(200)


def _char_cost(c: str) -> float:
    return 1.0 if c in "0123456789" else _log(26) if c.isalpha() and c.isascii() else _log(33) if c.isascii() else _log(1000)


def _agree(v: str, a: int, b: int, way: int) -> int:
    """How many characters from a and from b on (way 1) or before them (way -1) agree."""
    most = len(v) - max(a, b) if way > 0 else min(a, b)
    size, got = 1, 0
    while got < most:  # doubling slices, then halving ones
        k = min(size, most - got)
        x, y = (a + got, b + got) if way > 0 else (a - got - k, b - got - k)
        if v[x : x + k] == v[y : y + k]:
            got, size = got + k, size * 2
        elif k == 1:
            break
        else:
            most, size = got + k - 1, max(1, k // 2)
    return got


def repeats(v: str) -> list[tuple[int, int, int]]:
    """Every (start, end, period) of a longest stretch with that smallest period,
    at least two periods long. A stretch of period p agrees with itself p further
    on at some multiple of p, so n/p places are tried for each p."""
    n, found = len(v), []
    seen: dict[int, list[tuple[int, int, int]]] = {}  # the stretches that cover a tried place
    for p in range(1, n // 2 + 1):
        t = 0
        while t + p < n:
            if v[t] == v[t + p] and not any(p % q == 0 and l <= t and t + p < r for l, r, q in seen.get(t, ())):
                l = t - _agree(v, t, t + p, -1)
                r = t + p + _agree(v, t, t + p, 1)
                if r - l >= 2 * p:
                    found.append((l, r, p))
                    if r - l >= 4 * p:  # only these hold stretches of a multiple of p
                        for i in range(l, r - p):
                            seen.setdefault(i, []).append((l, r, p))
                    t = max(t, (r - p) // p * p)
            t += p
    return found


class _Starts:
    """Starts of one kind of run that may still be the cheapest: a run of m steps
    adds log m, so a later start wins early or, at a lower cost, for good."""

    def __init__(self) -> None:
        self.live: list[tuple[float, int]] = []

    def add(self, cost: float, start: int) -> None:
        while self.live and self.live[-1][0] >= cost:
            self.live.pop()
        self.live.append((cost, start))

    def least(self, end: int, period: int = 1) -> float:
        low, kept = math.inf, []
        for cost, start in self.live:
            f = cost + _log((end - start) // period)
            if f < low:
                low = f
                kept.append((cost, start))
        self.live = kept
        return low


def guess_cost(value: str, words: dict[str, int], longest: int | None = None, limit: float = math.inf, _units: dict[str, float] | None = None) -> float:
    """log10 of the guesses that the cheapest segmentation needs; each further segment doubles them.

    Segments: words (``longest`` characters at most, by default the longest of
    ``words``), years and dates, a unit of any length repeated (the cheapest
    segmentation of the unit, and log of the count; three characters or more),
    ascending and descending characters and keyboard walks of three or more (any
    part of a run), and brute force by character class. Above ``limit`` the cost
    is not followed: the result is then ``limit`` or more, not the exact cost."""
    n, low = len(value), value.lower()
    longest = max(map(len, words), default=0) if longest is None else longest
    units = {} if _units is None else _units
    if len(low) != n:  # a few capitals have lower-case forms of two characters
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = low.translate(LEET)
    step = _log(2)
    best = [0.0] + [math.inf] * n
    brute = [math.inf] * (n + 1)  # cheapest cost that ends inside a brute-force span
    chars = [_char_cost(c) for c in value]
    rise = [ord(value[i + 1]) - ord(value[i]) if value[i].isalnum() else 0 for i in range(n - 1)]
    links = (  # linked neighbours, cost of the first character, cost of each character
        ([x == 1 for x in rise], lambda i: chars[i], 0.0),
        ([x == -1 for x in rise], lambda i: chars[i] + step, 0.0),
        ([(low[i], low[i + 1]) in NEXT_KEYS for i in range(n - 1)], lambda i: _log(47) + step, step / 3),
    )
    lines = [_Starts() for _ in links]
    todo = sorted(repeats(value), reverse=True)
    open_runs: list[tuple[int, int, int, dict[int, _Starts]]] = []
    here = [math.inf] * (n + 1)

    def unit_cost(u: str) -> float:
        if u not in units:
            units[u] = _char_cost(u) if len(u) == 1 else guess_cost(u, words, longest, limit, units)
        return units[u]

    for j in range(n + 1):
        # spans that end at j
        best[j] = min(best[j], brute[j])
        for (linked, first, each), starts in zip(links, lines):
            if j < 3 or not linked[j - 2]:
                starts.live.clear()
                continue
            if linked[j - 3] and here[j - 3] < limit:
                starts.add(here[j - 3] + first(j - 3) - each * (j - 3), j - 3)
            if starts.live:
                best[j] = min(best[j], starts.least(j) + each * j)
        while todo and todo[-1][0] <= j:
            l, r, p = todo.pop()
            open_runs.append((l, r, p, {}))
        if open_runs:
            open_runs = [x for x in open_runs if x[1] >= j]
        for l, _, p, classes in open_runs:
            i = j - max(2 * p, 3)
            if i >= l:
                starts = classes.setdefault(j % p, _Starts())
                if here[i] < limit:
                    starts.add(here[i] + unit_cost(value[i : i + p]), i)
                if starts.live:
                    best[j] = min(best[j], starts.least(j, p))
        if j == n:
            break
        # spans that start at j
        here[j] = best[j] + (step if j else 0.0)
        brute[j + 1] = min(here[j], brute[j]) + chars[j]
        if here[j] >= limit:
            continue
        for e in range(j + 3, min(n, j + longest) + 1):
            for form, extra in ((low, 0.0), (plain, 1.0)):
                rank = words.get(form[j:e])
                if rank:
                    caps = 0.0 if value[j:e].islower() or not value[j:e].isalpha() else step if value[j:e].istitle() or value[j:e].isupper() else step * 3
                    best[e] = min(best[e], here[j] + _log(rank + 1) + extra * step + caps)
                    break
        if value[j].isdigit():
            for e, cost in _dates(value, j):
                best[e] = min(best[e], here[j] + cost)
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def context_spans(text: str, base, words: dict[str, int], longest: int, min_guesses: float) -> list[tuple[int, int, str]]:
    out, at, covered = [], 0, 0
    for m in CONTEXT.finditer(text):
        value = m[1].rstrip(".,;:)]}")
        a, b = m.start(1), m.start(1) + len(value)
        while at < len(base) and base[at][0] <= a:  # both lists ascend: how far base spans from a or before it reach
            covered, at = max(covered, base[at][1]), at + 1
        if len(value) >= 6 and b > covered and guess_cost(value, words, longest, min_guesses) >= min_guesses:
            out.append((a, b, "guess"))
    return out


def scan(docs: DataFrame, vocabulary: str = VOCABULARY, min_guesses: float = MIN_GUESSES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base (spans as kind:start:end) and spans, for every row."""
    ranks = load_words(vocabulary)
    longest = max(map(len, ranks), default=0)
    words = docs.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf("struct<n_assign:bigint,n_access:bigint,n_hex:bigint,base:string,spans:string>")
    def run(s: pd.Series) -> pd.DataFrame:
        rows = []
        for t in s:
            base = base_spans(t) if t else []
            more = context_spans(t, base, words.value, longest, min_guesses) if t else []
            every = sorted(base + more, key=lambda x: (x[0], [*KINDS, "guess"].index(x[2]), x[1]))
            say = [",".join(f"{k}:{a}:{b}" for a, b, k in x) for x in (base, every)]
            rows.append([sum(k == x for _, _, k in base) for x in KINDS] + say)
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "spans"])

    text: Column = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", run(F.when(text.rlike(TRIGGER), text)).alias("f"))
    return found.select("doc_id", "f.*")


@query("op5_secrets")
def op5_secrets(spark, d):
    """Secrets of every whole document."""
    s = scan(read(spark, d, "documents"))
    return s.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
