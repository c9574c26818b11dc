"""Exact deduplication by skew-safe combining, full contents compared at every stage.

1. Inside each Arrow batch equal texts become one row: digest, content
   (compressed, so that equal bytes are equal texts), member ids.
2. Those rows merge per (digest, salt, content), so a text that a third of all
   rows share is spread over ``salts`` tasks.
3. The salt winners merge per (digest, content). Grouping is by the content
   itself; two contents with one digest stay apart.
4. Every local row then learns its winner by digest, and by content as well
   where a digest has more than one.

Member lists are bounded by the batch. Null text counts as empty. Texts are
equal when they are after each run of ``[\\x20\\x09-\\x0D]`` became one space. Of
equal texts the smallest doc_id stays; among repeated rows of that id exactly
one does. Null ids come last. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import read, salt_of, stored
from quarry.llm.registry import query

SALTS = 64
_WHITE = b"\t\n\x0b\x0c\r "


def normalise(text: str | None) -> bytes:
    """UTF-8 with each white-space run as one space, also at the ends."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return raw
    body = b" ".join(raw.split())
    if not body:
        return b" "
    return (b" " if raw[:1] in _WHITE else b"") + body + (b" " if raw[-1:] in _WHITE else b"")


def sha256_hex(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


def local_groups(docs: DataFrame, digest=sha256_hex) -> DataFrame:
    """One row per (batch, text): digest, key, content, members, and the first member's place."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import zstandard

        squeeze, task, seq = zstandard.ZstdCompressor(level=1).compress, TaskContext.get().partitionId(), 0
        schema = None
        for b in batches:
            if not b.num_rows:
                continue
            ids, texts, found = b.column("doc_id"), b.column("text"), {}
            for i, t in enumerate(texts):
                found.setdefault(normalise(t.as_py()), []).append(i)
            id_list = ids.to_pylist()
            out = {c: [] for c in ("digest", "sha", "content", "members", "no_id", "first_id", "task", "seq")}
            for content, at in found.items():
                own = sorted((id_list[i] for i in at), key=lambda x: (x is None, x if x is not None else 0))
                sha = sha256_hex(content)
                out["digest"].append(sha if digest is sha256_hex else digest(content))
                out["sha"].append(sha)
                out["content"].append(squeeze(content))
                out["members"].append(own)
                out["no_id"].append(own[0] is None)
                out["first_id"].append(own[0])
                out["task"].append(task)
                out["seq"].append(seq)
                seq += 1
            schema = schema or pa.schema([("digest", pa.string()), ("sha", pa.string()), ("content", pa.binary()), ("members", pa.list_(ids.type)), ("no_id", pa.bool_()), ("first_id", ids.type), ("task", pa.int32()), ("seq", pa.int64())])
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, f"digest string, sha string, content binary, members array<{kind}>, no_id boolean, first_id {kind}, task int, seq bigint")


def duplicate_groups(docs: DataFrame, salts: int = SALTS, digest=sha256_hex) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per document row."""
    local = stored(local_groups(docs, digest), "dedup")
    best, n = F.min("first").alias("first"), F.sum("n").alias("n")
    parts = local.select("digest", "content", F.struct("no_id", "first_id", "task", "seq").alias("first"), F.size("members").cast("bigint").alias("n"), salt_of("task", "seq", buckets=salts).alias("salt"))
    salted = parts.groupBy("digest", "salt", "content").agg(best, n)
    winners = salted.groupBy("digest", "content").agg(best, n)
    variants = stored(winners.groupBy("digest").agg(F.count("*").alias("v"), F.min("first").alias("first"), F.sum("n").alias("n")), "winners")
    # one content under a digest: the digest stands for it, shown by the comparison above
    single = local.drop("content").join(variants.where("v = 1").drop("v"), "digest")
    named = single
    clash = variants.where("v > 1").select("digest")
    if not clash.isEmpty():  # these alone carry their contents into a join once more
        few = stored(clash, "clash")
        several = local.join(few, "digest", "left_semi").join(winners.join(few, "digest", "left_semi"), ["digest", "content"]).drop("content")
        named = single.unionByName(several)
    mine = (F.col("first.task") == F.col("task")) & (F.col("first.seq") == F.col("seq"))
    each = named.select("sha", F.col("first.first_id").alias("keep_id"), F.col("n").alias("group_size"), mine.alias("mine"), F.posexplode("members").alias("at", "doc_id"))
    # members are sorted by id: the first one of the winning local row is the one that stays
    return each.select("doc_id", "keep_id", "group_size", (F.col("mine") & (F.col("at") == 0)).alias("kept"), F.col("sha").alias("text_sha256"))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT *, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id) AS r FROM d)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, r = 1 AS kept, sha256(t) AS text_sha256 FROM g
"""


@query("op8_exact_dedup", OP8_SQL)
def op8_exact_dedup(spark, d):
    """Group of equal texts and the row that stays, for every document."""
    return duplicate_groups(read(spark, d, "documents"))
