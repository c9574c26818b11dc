"""Benchmark decontamination: a hash set of test n-grams scanned over every token window.

DataFrame functions only. The benchmark's windows (``n`` words, or a whole
shorter item) are hashed into a fixed-size bit set that travels as a literal;
each document tests all its windows against it inside its own row. Windows that
pass carry their words into a join with the exact windows, which verifies them.
The join is broadcast while the windows are below ``broadcast_bytes``; beyond
that it is a shuffle join, which AQE splits on a hot passage.

Null and empty texts have no words; repeated rows are judged one by one and get
equal results; a null item id counts as the item ''; an empty benchmark hits
nothing. Other columns of the input, whatever their names, are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import let
from quarry.llm.common import ascii_lower, fields_of, quoted, read, stored, whole_rows
from quarry.llm.registry import query

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]*"


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def benchmark_windows(bench: DataFrame, n: int = 10) -> DataFrame:
    """Distinct (gram, len, item): every window of ``n`` words, or the whole of a shorter item."""
    items = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(n)))
    gram = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1), lambda i: F.slice("w", i, F.col("len")))
    return items.select("item", "len", F.explode(gram).alias("ws")).select(F.array_join("ws", " ").alias("gram"), "len", "item", F.xxhash64("ws").alias("h")).distinct()


def _bit_set(grams: DataFrame, lens: list[int], n_grams: int) -> tuple[Column, int]:
    """The windows' hashes as a literal array of 64-bit words. At least 64 bits a
    window up to 2^23 bits (1 MB), its proven bound; beyond that the set only
    passes more windows on to the exact join."""
    bits = 1 << min(23, max(16, (64 * n_grams - 1).bit_length()))
    slots = grams.select(F.pmod(F.col("h"), F.lit(bits)).alias("slot"))
    rows = slots.select(F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, int(slot % 64))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    table = [0] * (bits // 64)
    for r in rows:
        table[r["word"]] = r["bits"]
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>"), bits


def scan(docs: DataFrame, bench: DataFrame, n: int = 10, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """One row per document row: doc_id, text_key (hash of the text), n_words,
    spans (hit word ranges as (pos, len), 1-based), items (their item ids, sorted)."""
    grams = stored(benchmark_windows(bench, n), "grams")
    head = grams.agg(F.count("*"), F.sum(F.length("gram") + F.length("item") + 16), F.collect_set("len")).first()  # at most n lengths
    n_grams, size, lens = head[0], head[1] or 0, sorted(head[2])
    base = docs.select("doc_id", F.col("text").alias("_t")).select("doc_id", F.xxhash64("_t").alias("text_key"), F.monotonically_increasing_id().alias("_row"), words(F.col("_t")).alias("w"))
    if not lens:
        span = "array<struct<pos:int,len:int>>"
        return base.select("doc_id", "text_key", F.size("w").cast("bigint").alias("n_words"), F.array().cast(span).alias("spans"), F.array().cast("array<string>").alias("items"))
    table, bits = _bit_set(grams, lens, n_grams)

    def candidates(w, k):
        at = F.when(F.size(w) >= k, F.sequence(F.lit(1), F.size(w) - (k - 1))).otherwise(F.array().cast("array<int>"))

        def passes(i):
            return let(F.pmod(F.xxhash64(F.slice(w, i, F.lit(k))), F.lit(bits)), lambda s: F.getbit(F.get(table, F.shiftright(s, 6).cast("int")), (s % 64).cast("int")) == 1)

        return F.transform(F.filter(at, passes), lambda i: F.struct(i.alias("pos"), F.lit(k).alias("len"), F.array_join(F.slice(w, i, F.lit(k)), " ").alias("gram")))

    found = base.select("doc_id", "text_key", "_row", F.size("w").cast("bigint").alias("n_words"), F.concat(*[candidates(F.col("w"), k) for k in lens]).alias("c"))
    # a row without candidates gets a key of its own that no window has, or a shuffle join would deal all of them to one task
    alone = F.concat(F.lit(" "), F.col("_row").cast("string"))
    rows = found.select("doc_id", "text_key", "_row", "n_words", F.explode_outer("c").alias("c")).select("doc_id", "text_key", "_row", "n_words", F.col("c.pos").alias("pos"), F.col("c.len").alias("len"), F.coalesce(F.col("c.gram"), alone).alias("gram"))
    exact = grams.select("gram", "item")
    hit = rows.join(F.broadcast(exact) if size < broadcast_bytes else exact, "gram", "left")
    out = hit.groupBy("_row", "doc_id", "text_key", "n_words").agg(
        F.array_sort(F.collect_set(F.when(F.col("item").isNotNull(), F.struct("pos", "len")))).alias("spans"), F.array_sort(F.collect_set("item")).alias("items")
    )
    return out.drop("_row")


def n_hit(spans: Column) -> Column:
    """Words covered by sorted (pos, len) ranges."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))

    def step(acc, s):
        end = s["pos"] + s["len"]
        fresh = F.greatest(end - F.greatest(s["pos"], acc["end"]), F.lit(0))
        return F.struct((acc["n"] + fresh).alias("n"), F.greatest(end, acc["end"]).alias("end"))

    return F.aggregate(spans, start, step, lambda acc: acc["n"])


def remove_documents(docs: DataFrame, bench: DataFrame, n: int = 10, broadcast_docs: int = 2_000_000) -> DataFrame:
    """The documents without any verified hit, all their columns as they were.

    The keys of the hit ones are counted first and broadcast up to
    ``broadcast_docs`` (32 MB); beyond, the texts are shuffled to meet them."""
    bad = stored(scan(docs, bench, n).where(F.size("items") > 0).select(F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_key")).distinct(), "hits")
    few = F.broadcast(bad) if bad.count() <= broadcast_docs else bad
    rows = whole_rows(docs, doc_id=quoted("doc_id"), text_key=F.xxhash64(quoted("text")))
    clean = rows.join(few, F.col("doc_id").eqNullSafe(F.col("_bad_id")) & (F.col("text_key") == F.col("_bad_key")), "left_anti")
    return clean.select(*fields_of(docs))


def remove_spans(docs: DataFrame, bench: DataFrame, n: int = 10) -> DataFrame:
    """Every document, the hit words cut out of its text together with what separates them from the word before."""
    hits = scan(docs, bench, n).where(F.size("items") > 0).dropDuplicates(["doc_id", "text_key"]).select(F.col("doc_id").alias("_h_id"), F.col("text_key").alias("_h_key"), F.col("spans").alias("_h_spans"))
    rows = whole_rows(docs, doc_id=quoted("doc_id"), text_key=F.xxhash64(quoted("text")))
    j = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("_h_id")) & (F.col("text_key") == F.col("_h_key")), "left")
    raw_word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    raw_sep = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
    text = F.col("row").getField("text")
    # one part a word, with what is before it; separators after the last word are a part of their own, never hit.
    # Possessive, so that a long run of separators is read once
    parts = F.regexp_extract_all(text, F.lit(f"{raw_sep}+{raw_word}|{raw_sep[:-1]}++"), F.lit(0))
    hit_at = F.array_distinct(F.flatten(F.transform("_h_spans", lambda s: F.sequence(s["pos"], s["pos"] + s["len"] - 1))))
    # positions kept: a hash-based difference, then one pass over the words
    cut = let(parts, lambda ps: F.array_join(F.transform(F.array_except(F.when(F.size(ps) > 0, F.sequence(F.lit(1), F.size(ps))).otherwise(F.array().cast("array<int>")), hit_at), lambda i: F.get(ps, i - 1)), ""))
    new = F.when(F.col("_h_key").isNull(), text).otherwise(cut)
    return j.select(*fields_of(docs, text=new))


OP1_SQL = r"""
WITH norm AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM norm),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
      FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
p AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
      FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM g) WHERE len(w) >= k)),
h AS (SELECT DISTINCT p.r, p.i, p.k, g.item_id FROM p JOIN g ON p.gram = g.gram AND p.k = g.k),
c AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS x FROM (SELECT DISTINCT r, i, k FROM h)) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM h) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(it.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(it.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.r = c.r LEFT JOIN it ON d.r = it.r
"""


@query("op1_decontaminate", OP1_SQL)
def op1_decontaminate(spark, d):
    """Hit words and benchmark items of every whole document."""
    s = scan(read(spark, d, "documents"), read(spark, d, "benchmark"))
    hit = n_hit(F.col("spans"))
    return s.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
