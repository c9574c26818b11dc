import hashlib
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import decontaminate as D

from .edge import LONG, documents, rows_of

BENCH = [
    (10, "the quick brown fox jumps over the lazy dog and"),
    (11, "Jumps over!"),  # shorter than a window: one window of two words
    (11, "Jumps over!"),  # repeated
    (12, None),
    (13, "..."),
    (None, "a document without an id"),
    (2, "brown fox jumps over the lazy dog and runs away home"),
]


def words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, bench):
    w, hit, items = words(text), set(), set()
    for item, t in bench:
        b = words(t)
        k = min(10, len(b))
        for i in range(len(b) - k + 1 if k else 0):
            for j in range(len(w) - k + 1):
                if w[j : j + k] == b[i : i + k]:
                    hit |= set(range(j, j + k))
                    items.add("" if item is None else str(item))
    return len(w), len(hit), sorted(items)


def bench_table(spark, rows=BENCH):
    return spark.createDataFrame(rows, "item_id bigint, text string").withColumn("gram", F.lit("kept"))


@pytest.mark.parametrize("limit", [32 << 20, 0])  # broadcast and shuffle join
def test_against_brute_force(spark, limit):
    docs = documents(spark)
    got = sorted((r["doc_id"] or -1, r["n_words"], r["hit"], tuple(r["items"])) for r in rows_of(D.scan(docs, bench_table(spark), broadcast_bytes=limit).withColumn("hit", D.n_hit(F.col("spans")))))
    want = []
    for r in docs.select("doc_id", "text").collect():
        n, h, items = brute(r["text"], BENCH)
        want.append((r["doc_id"] or -1, n, h, tuple(items)))
    assert got == sorted(want)
    assert len(got) == docs.count()


def test_removal(spark):
    docs = documents(spark)
    kept = D.remove_documents(docs, bench_table(spark))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in rows_of(kept)) == [3, 4, 5, 6, 7, 8, 9]
    assert sorted(r["doc_id"] for r in rows_of(D.remove_documents(docs, bench_table(spark), broadcast_docs=0))) == [3, 4, 5, 6, 7, 8, 9]
    cut = {(r["doc_id"], r["text"]) for r in rows_of(D.remove_spans(docs, bench_table(spark)))}
    assert (1, " today") in cut and (6, LONG) in cut and (3, None) in cut and (4, "") in cut


def test_spans_keep_what_surrounds_them(spark):
    gap = " \n" * 200_000
    rows = [(1, "Start, " + BENCH[0][1].upper() + "!" + gap, None, None), (2, gap + "a b " + BENCH[1][1] + gap + "end.", None, None), (3, gap, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    cut = {r["doc_id"]: r["text"] for r in rows_of(D.remove_spans(docs, bench_table(spark)))}
    assert cut == {1: "Start!" + gap, 2: gap + "a b!" + gap + "end.", 3: gap}


def test_empty_tables(spark):
    docs, bench = documents(spark), bench_table(spark)
    assert D.scan(docs.limit(0), bench).count() == 0
    none = rows_of(D.scan(docs, bench.limit(0)))
    assert len(none) == docs.count() and all(r["items"] == [] and r["spans"] == [] for r in none)
    assert D.remove_documents(docs, bench.limit(0)).count() == docs.count()


def test_full_bit_set_still_verifies(spark):
    """Hash collisions only pass candidates on: results stay exact."""
    text = " ".join(f"w{i}" for i in range(300))
    docs = spark.createDataFrame([(1, text, None, None)], "doc_id bigint, text string, lang string, source string")
    bench = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i, i + 10))) for i in range(0, 290, 7)], "item_id bigint, text string")
    r = rows_of(D.scan(docs, bench).withColumn("hit", D.n_hit(F.col("spans"))))[0]
    assert r["hit"] == len({j for i in range(0, 290, 7) for j in range(i, i + 10)}) and len(r["items"]) == 42


def test_digest_is_sha256_of_ids():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
