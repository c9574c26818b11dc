import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import merkle as M

from .edge import documents

H = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return H(*[enc(x) for x in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])


def grown(leaves):
    """Levels of digests from the leaves to the one root."""
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def climbed(levels, i, h):
    proof = []
    for level in levels[:-1]:
        run = level[i - i % 3 : i - i % 3 + 3]
        proof += run[: i % 3] + run[i % 3 + 1 :]
        h = H(*run[: i % 3], h, *run[i % 3 + 1 :])
        i //= 3
    return h, proof


def brute(rows, forge=None):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[s] = grown([leaf(r, r["text"]) for r in by[s]])
    top = grown([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(by[s]):
            h, proof = climbed(trees[s], i, leaf(r, forge(r) if forge else r["text"]))
            h, more = climbed(top, k, h)
            out.append((r["doc_id"], trees[s][0][i], trees[s][-1][0], top[-1][0], H(*proof, *more), h))
    return Counter(out)


def forged(r):
    even = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
    return r["text"].replace("\n", "") if even and r["text"] is not None else r["text"]


def result(m):
    h = lambda c: F.lower(F.hex(c))
    p = F.sha2(h("siblings"), 256)
    return Counter(tuple(r) for r in m.select("doc_id", h("leaf"), h("subroot"), h("root"), p, h("folded")).collect())


def table(spark, n, sources, seed=0):
    r = random.Random(seed)
    rows = [(r.randrange(n * 2) if r.random() > 0.03 else None, "line\n" * r.randrange(3) + r.choice(["é", "x", ""]), r.choice(["en", None]), r.choice(sources), r.choice([None, 3])) for _ in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def check(docs, forge=None):
    rows = [r.asDict() for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    bad = M.without_line_ends(F.col("doc_id"), F.col("text")) if forge else None
    assert result(M.manifest(docs, bad)) == brute(rows, forge)


@pytest.mark.parametrize("n,sources", [(95, ["a", "b", None, "é"]), (40, ["only"]), (12, [chr(97 + i) for i in range(26)])])
def test_against_brute_force(spark, n, sources):
    check(table(spark, n, sources, n).repartition(5), forged)


def test_upper_runs_are_stored_once_per_chunk(spark, monkeypatch):
    monkeypatch.setattr(M, "CHUNK_STEPS", 1)
    monkeypatch.setattr(M, "CHUNK", 9)
    check(table(spark, 90, ["a", "a", "a", "b", "c", "d", None], 7), forged)


def test_edges(spark):
    docs = documents(spark).withColumn("n_chars", F.lit(4)).withColumn("tree", F.lit("kept")).withColumn("a.b", F.lit("kept"))
    check(docs, forged)
    check(docs.where("doc_id = 9"), forged)  # one row: an empty proof
    check(docs.where("doc_id = 2"))  # repeated rows
    assert M.manifest(docs.limit(0)).count() == 0
    assert M.manifest(docs).where("folded <> root").count() == 0


def test_encoding_and_limits(spark):
    rows = [r.asDict() for r in documents(spark).select("doc_id", "text").collect()]
    assert rows and enc("é") == "2:é" and enc(None) == "-"
    before = spark.conf.get("spark.sql.cteRecursionRowLimit", None)
    M.manifest(table(spark, 9, ["a"])).count()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit", None) == before
