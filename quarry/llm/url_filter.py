"""URL filter: every glob rule at once, by a bit-parallel Shift-And automaton.

Each glob is laid out as one bit per symbol in a row of 64-bit words (as many
words as the rules need; the shift carries from word to word). For each byte a
mask says which states that byte enters; ``*`` is a state that keeps itself.
A batch of URLs advances together, one byte position a step, in numpy.

A URL is matched in the form ``host#path``: ``#`` occurs once, so a ``*`` in the
host part of a rule never runs into the path. ``?`` stands for one byte.

Null URLs and those without ``://`` have empty host and path and get the
default verdict. Repeated rows get equal results; an empty table gives an empty
result; URLs of any length are read whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import LOWER, UPPER, fresh, quoted, read
from quarry.llm.registry import query

# Fixed values: (verdict, host, path); a rule fits its host and all subdomains, paths that start with its path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]

# What decides where no rule fits: globs of hosts and paths that are blocked; anything else is allowed.
BLOCKED = [
    "*adult*#*", "*casino*#*", "*cheap-pills*#*", "*gambl*#*", "*porn*#*", "*replica-watch*#*", "*spam*#*", "*viagra*#*", "*warez*#*", "*xxx*#*",
    "*#*/wp-login.php*", "*#*.exe", "*#*.apk", "*#/ads/*", "*#/cgi-bin/*",
]


class ShiftAnd:
    """All globs of a list, simulated side by side."""

    def __init__(self, globs: list[str]):
        starts, ends, loops, enters, at = [], [], [], [[] for _ in range(256)], 0
        for g in globs:
            starts.append(at)
            for b in g.encode():
                if b == ord("*"):
                    loops.append(at)
                    continue
                at += 1
                for c in range(256) if b == ord("?") else (b,):
                    enters[c].append(at)
            ends.append(at)
            at += 1
        self.words = max(1, (at + 63) // 64)
        self.start, self.keep = self._mask(starts), self._mask(loops)
        self.enter = np.stack([self._mask(e) for e in enters])
        self.end_word, self.end_bit = np.array(ends, np.int64) // 64, np.array(ends, np.uint64) % np.uint64(64)

    def _mask(self, bits: list[int]) -> np.ndarray:
        m = np.zeros(self.words, np.uint64)
        for b in bits:
            m[b // 64] |= np.uint64(1 << (b % 64))
        return m

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """One row per text, one column per glob."""
        n = len(texts)
        size = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-size, kind="stable")
        offset = np.concatenate(([0], np.cumsum(size)))[:-1][order]
        buf = np.frombuffer(b"".join(texts), np.uint8)
        by_size = size[order]
        state = np.tile(self.start, (n, 1))
        for j in range(int(by_size[0]) if n else 0):
            live = int(np.searchsorted(-by_size, -j, side="left"))  # texts longer than j
            d = state[:live]
            shifted = d << np.uint64(1)
            shifted[:, 1:] |= d[:, :-1] >> np.uint64(63)
            state[:live] = (shifted & self.enter[buf[offset[:live] + j]]) | (d & self.keep)
        out = np.empty((n, len(self.end_word)), bool)
        out[order] = (state[:, self.end_word] >> self.end_bit) & np.uint64(1) != 0
        return out


def matched_globs(target: Column, globs: list[str]) -> Column:
    """Numbers of the globs that match the whole of ``target``, ascending."""

    @F.pandas_udf("array<int>")
    def run(s: pd.Series) -> pd.Series:
        m = ShiftAnd(globs).matches([t.encode("utf-8", "surrogatepass") for t in s])
        rows, cols = np.nonzero(m)
        return pd.Series(np.split(cols.astype(np.int32), np.cumsum(np.bincount(rows, minlength=len(s)))[:-1])) if len(s) else pd.Series([], dtype=object)

    return run(target)


def url_parts(url: Column) -> tuple[Column, Column]:
    after = F.substring(url, F.locate("://", url) + 3, F.length(url))
    rest = F.coalesce(F.when(F.locate("://", url) > 0, after), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def judge(pages: DataFrame, rules=RULES, blocked=BLOCKED, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict added (columns of these names are replaced, others left alone); the longest fitting rule wins
    (ties: the longer host, then the rule's text), else any blocked glob blocks."""
    globs, owner = [], []
    for i, (_, host, path) in enumerate(rules):
        globs += [f"{host}#{path}*", f"*.{host}#{path}*"]
        owner += [i, i]
    rank = sorted(range(len(rules)), key=lambda i: (-len(rules[i][1] + rules[i][2]), -len(rules[i][1]), rules[i][1] + rules[i][2]))
    place = {r: p for p, r in enumerate(rank)}
    best_of = F.array(*[F.lit(place[o]) for o in owner])
    names = F.array(*[F.lit(rules[r][1] + rules[r][2]) for r in rank])
    verdicts = F.array(*[F.lit(rules[r][0]) for r in rank])
    host, path = url_parts(quoted(url))
    found, first = fresh(pages, "hits_"), fresh(pages, "best_")
    p = pages.withColumn("host", host).withColumn("path", path)
    p = p.withColumn(found, matched_globs(F.concat("host", F.lit("#"), "path"), globs + blocked))
    best = F.array_min(F.transform(F.filter(found, lambda h: h < len(globs)), lambda h: F.get(best_of, h)))
    p = p.withColumn(first, best)
    fallback = F.when(F.exists(found, lambda h: h >= len(globs)), "block").otherwise("allow")
    return p.withColumn("rule", F.get(names, F.col(first))).withColumn("verdict", F.coalesce(F.get(verdicts, F.col(first)), fallback)).drop(found, first)


def _like(rule):
    verdict, host, path = rule
    return f"SELECT '{host}{path}' AS rule, '{verdict}' AS v, '{host}' AS h, '{path}' AS p"


OP2_SQL = (
    r"""
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS r FROM r),
k AS ("""
    + " UNION ALL ".join(_like(x) for x in RULES)
    + r"""),
m AS (SELECT u.r, arg_max(k.rule, length(k.rule)) AS rule, arg_max(k.v, length(k.rule)) AS v
      FROM u JOIN k ON (u.host = k.h OR ends_with(u.host, '.' || k.h)) AND starts_with(u.path, k.p) GROUP BY u.r)
SELECT page_id, host, path, m.rule, coalesce(m.v, CASE WHEN """
    + " OR ".join(f"(host || '#' || path) GLOB '{g}'" for g in BLOCKED)
    + r""" THEN 'block' ELSE 'allow' END) AS verdict FROM u LEFT JOIN m ON u.r = m.r
"""
)


@query("op2_url_filter", OP2_SQL)
def op2_url_filter(spark, d):
    """Host, path, rule and verdict of every page's URL."""
    return judge(read(spark, d, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")
