import hashlib
import re
from collections import Counter, defaultdict

import pytest

from quarry.llm import exact_dedup as E

from .edge import documents, rows_of


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def check(out, rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[norm(t)].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out) == want
    kept = [r for r in out if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)


ROWS = [(i, f"text {i % 40}" + "  \t" * (i % 3) + " end" + "\n" * (i % 2), "en", "a") for i in range(400)] + [(1000 + i, "hot", "en", "a") for i in range(700)] + [(1003, "hot", "en", "a"), (None, "hot", "en", "a"), (1, "a\u00a0b", "", ""), (2, "a b", "", ""), (3, "a\x1cb", "", "")]


def test_normalise():
    for t in (None, "", " ", "\t\n", " a", "a ", "a \n b", "\x0ba\x0c", "a\u00a0 b", "\x1c a", "é  ü "):
        assert E.normalise(t).decode() == norm(t), repr(t)


@pytest.mark.parametrize("parts", [1, 9])
def test_against_brute_force(spark, parts):
    check(rows_of(E.duplicate_groups(documents(spark, ROWS).repartition(parts))), ROWS)


def test_digest_collisions_are_told_apart(spark):
    """A digest of two values only: groups come from the contents."""
    out = rows_of(E.duplicate_groups(documents(spark, ROWS).repartition(5), digest=lambda c: str(len(c) % 2)))
    check(out, ROWS)


def test_edges(spark):
    docs = documents(spark)
    check(rows_of(E.duplicate_groups(docs)), [tuple(r)[:4] for r in docs.select("doc_id", "text", "lang", "source").collect()])
    assert E.duplicate_groups(docs.limit(0)).count() == 0
    check(rows_of(E.duplicate_groups(documents(spark, [(None, "x", None, None)] * 4))), [(None, "x")] * 4)
