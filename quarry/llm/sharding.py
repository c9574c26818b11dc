"""Balanced label propagation: linked documents move to their neighbours' shard under quotas.

Documents are linked through a group (here: equal texts). A group's members
count by shard; that small table (group, shard, n) is what the rounds work on,
so a group that holds a third of all rows is a few rows. Each round, members
outside their group's fullest shard ask to move there; the requests are summed
per pair of shards, answered by a quota (swaps first, then free room), and the
largest groups move first. Shards may run over a little meanwhile; after the
last round each keeps its largest parts up to its capacity, the rest and then
all documents without links fill the free room.

Law ``rows``: shard counts are at most one apart, whatever the links.
Slots number each shard's rows without gaps. Ranks are exact and distributed:
hash buckets first, then windows inside a bucket; the buckets grow in number
with the rows, so that a bucket stays at about a million.

Null text: size 1 (0 bytes plus 1), and linked like the empty text. Repeated
rows are rows like any other, linked by their text; null ids sort first. Empty
table: empty result. Other columns of the input are left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import fresh, quoted, read, running_total, salt_of, stored
from quarry.llm.registry import query

SHARDS = 8
ROUNDS = 6
SLACK = 0.2


def quotas(asked: dict[tuple[int, int], int], sizes: list[int], caps: list[int]) -> dict[tuple[int, int], int]:
    """How many of the asked moves each pair of shards may make: swaps keep every
    size, then the free room of a shard goes to those still asking for it."""
    give = {(i, j): min(n, asked.get((j, i), 0)) for (i, j), n in asked.items()}
    room = [c - s for c, s in zip(caps, sizes)]
    for i, j in sorted(asked, key=lambda ij: (ij[1], ij[0])):
        more = max(0, min(asked[i, j] - give[i, j], room[j]))
        give[i, j] += more
        room[j] -= more
        room[i] += more
    return give


def buckets_for(rows: int, least: int, each: int = 1 << 20) -> int:
    """Hash buckets for exact ranks: ``least`` of them, or one per ``each`` rows."""
    return max(least, rows // each)


def _by_size(n, key, parts: int):
    """Buckets that put larger parts first: by power of two, each in ``parts`` by hash."""
    return (F.greatest(F.lit(0), F.lit(40) - F.floor(F.log2(n)).cast("int")) * parts + salt_of(key, buckets=parts)).cast("int")


def _capped(state: DataFrame, n_shards: int, quota: dict, key, parts: int) -> DataFrame:
    """``state`` rows (group, shard, n, to): moved is how many of n go from shard to ``to``."""
    q = F.array(*[F.lit(quota.get((i, j), 0)).cast("bigint") for i in range(n_shards) for j in range(n_shards)])
    ask = state.where(F.col("to") != F.col("shard"))
    ranked = running_total(ask.withColumn("_bucket", _by_size(F.col("n"), key, parts)), ["shard", "to"], [F.desc("n"), key], F.col("n"), "before")
    left = F.get(q, F.col("shard") * n_shards + F.col("to")) - F.col("before")
    return ranked.select("g", "shard", "to", F.greatest(F.least(left, F.col("n")), F.lit(0)).alias("moved")).where("moved > 0")


def propagate(members: DataFrame, caps: list[int], rounds: int = ROUNDS) -> DataFrame:
    """(g, shard, n) from (g, shard, n): label propagation under capacities.

    Rounds end early when nobody moves. Only shards x shards sums and sizes
    reach the driver."""
    k = len(caps)
    cur = stored(members, "lp")
    parts = buckets_for(sum(caps), 8, 1 << 26)
    for _ in range(rounds):
        sizes = {r["shard"]: r["n"] for r in cur.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        # the fullest shard of a group; a group already filling a full shard sends the rest to its next one
        w = Window.partitionBy("g").orderBy(F.desc("n"), F.xxhash64("g", "shard"))
        full = [s for s in range(k) if sizes.get(s, 0) >= caps[s]]
        rank = cur.withColumn("r", F.row_number().over(w))
        best = rank.groupBy("g").agg(F.min_by("shard", "r").alias("to"), F.min_by("shard", F.when(~F.col("shard").isin(full), F.col("r"))).alias("open") if full else F.min_by("shard", "r").alias("open"))
        # a member of the fullest shard stays; others ask for it, or for the fullest one with room if it is full
        wish = cur.join(best, "g").withColumn("to", F.when(F.col("shard") == F.col("to"), F.col("shard")).when(F.col("to").isin(full), F.coalesce("open", "to")).otherwise(F.col("to"))) if full else cur.join(best, "g")
        wish = wish.select("g", "shard", "n", "to")
        asked = {(r["shard"], r["to"]): r["n"] for r in wish.where("shard != to").groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}
        quota = quotas(asked, [sizes.get(s, 0) for s in range(k)], caps)
        if not any(quota.values()):
            break
        moves = _capped(wish, k, quota, F.col("g"), parts)
        delta = moves.select("g", "shard", (-F.col("moved")).alias("n")).unionByName(moves.select("g", F.col("to").alias("shard"), F.col("moved").alias("n")))
        cur = stored(cur.unionByName(delta).groupBy("g", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "lp")
    return cur


def assign(rows: DataFrame, n_shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (columns doc_id, g and any others) with shard and slot added.

    ``g`` names the group of linked documents (never null)."""
    rows = stored(rows, "shardrows")
    total = rows.count()
    parts, buckets, salts = buckets_for(total, 8, 1 << 26), buckets_for(total, 256), buckets_for(total, 64)
    caps = [total // n_shards + (1 if s < total % n_shards else 0) for s in range(n_shards)]
    first = F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(n_shards)).cast("int")
    counts = rows.groupBy("g", first.alias("shard")).agg(F.count("*").alias("n"))
    linked = Window.partitionBy("g")
    counts = counts.withColumn("_all", F.sum("n").over(linked)).where("_all > 1").drop("_all")
    # while labels spread, shards may run over by SLACK; then each gives up what is
    # beyond its capacity, its smallest parts, which fill the free room part by part
    state = propagate(counts, [c + int(c * SLACK) + 1 for c in caps], rounds)
    sized = running_total(state.withColumn("_bucket", _by_size(F.col("n"), F.col("g"), parts)), ["shard"], [F.desc("n"), "g"], F.col("n"), "before")
    cap = F.get(F.array(*[F.lit(c).cast("bigint") for c in caps]), F.col("shard"))
    sized = stored(sized.select("g", "shard", "n", F.greatest(F.least(F.col("n"), cap - F.col("before")), F.lit(0)).alias("held")), "held")
    used = {r["shard"]: r["n"] for r in sized.groupBy("shard").agg(F.sum("held").alias("n")).collect()}
    spare = sized.where("n > held").select("g", (F.col("n") - F.col("held")).alias("n"), F.lit(0).alias("_part")).groupBy("g", "_part").agg(F.sum("n").alias("n"))
    spare = running_total(spare.withColumn("_bucket", _by_size(F.col("n"), F.col("g"), parts)), ["_part"], [F.desc("n"), "g"], F.col("n"), "at")
    room, start = [], 0
    for s in range(n_shards):
        room.append((start, start + caps[s] - used.get(s, 0)))
        start = room[-1][1]
    into = F.array(*[F.struct(F.lit(s).alias("shard"), (F.least(F.col("at") + F.col("n"), F.lit(e)) - F.greatest(F.col("at"), F.lit(b))).alias("n")) for s, (b, e) in enumerate(room)])
    spare = spare.select("g", F.explode(into).alias("p")).select("g", "p.shard", "p.n").where("n > 0")
    held = stored(sized.select("g", "shard", F.col("held").alias("n")).where("n > 0").unionByName(spare).groupBy("g", "shard").agg(F.sum("n").alias("n")), "plan")
    used = {r["shard"]: r["n"] for r in held.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    plan = held.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("parts"))  # n_shards entries at most
    # a member's rank in its group decides its part; ranks are salted, and the plan
    # reaches the members per (group, salt), so that a hot group is many windows and join keys
    salted = rows.withColumn("_bucket", salt_of("doc_id", F.lit("rank"), buckets=salts))
    before = Window.partitionBy("g").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = salted.groupBy("g", "_bucket").agg(F.count("*").alias("_n"))
    info = sums.select("g", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")).join(plan, "g", "left")
    inside = F.row_number().over(Window.partitionBy("g", "_bucket").orderBy("doc_id")) - 1
    ranked = salted.withColumn("_in", inside).join(info, ["g", "_bucket"]).withColumn("_rank", F.col("_off") + F.col("_in"))
    start = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(None).cast("int").alias("shard"))
    pick = F.aggregate(
        "parts", start, lambda acc, p: F.struct((acc["end"] + p["n"]).alias("end"), F.coalesce(acc["shard"], F.when(F.col("_rank") < acc["end"] + p["n"], p["shard"])).alias("shard")), lambda acc: acc["shard"]
    )
    both = stored(ranked.withColumn("shard", F.when(F.col("parts").isNotNull(), pick)).drop("_bucket", "_in", "_off", "_rank", "parts"), "placed")
    # documents without links fill the room left, in the order of a distributed rank
    pool = both.where(F.col("shard").isNull()).drop("shard").withColumn("_part", F.lit(0)).withColumn("_bucket", salt_of("doc_id", F.lit("pool"), buckets=buckets))
    pool = running_total(pool, ["_part"], ["doc_id", "g"], F.lit(1), "_rank")
    ends, at = [], 0
    for s in range(n_shards):
        at += caps[s] - used.get(s, 0)
        ends.append(at)
    fill = F.coalesce(*[F.when(F.col("_rank") < e, F.lit(s)) for s, e in enumerate(ends)])
    pool = pool.withColumn("shard", fill.cast("int")).drop("_part", "_bucket", "_rank")
    done = both.where(F.col("shard").isNotNull()).unionByName(pool)
    slots = running_total(done.withColumn("_bucket", salt_of("doc_id", F.lit("slot"), buckets=buckets)), ["shard"], ["doc_id", "g"], F.lit(1), "slot")
    return slots.drop("_bucket")


def with_shards(docs: DataFrame, n_shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """All rows and columns of ``docs`` with shard and slot added; equal texts are linked.

    Columns of these two names are replaced. Ids and even whole rows may repeat,
    so every row gets a key in a written copy; keys and text digests are placed,
    and the places are joined to the rows once, by the key."""
    keyed = docs.drop("shard", "slot")
    names, key = keyed.columns, fresh(docs, "rowkey_")
    keyed = stored(keyed.withColumn(key, F.monotonically_increasing_id()), "shardtexts")
    digest = F.unhex(F.sha2(F.coalesce(quoted("text"), F.lit("")).cast("binary"), 256))
    placed = assign(keyed.select("doc_id", digest.alias("g"), F.col(key).alias("rowkey_")), n_shards, rounds)
    places = placed.select(F.col("rowkey_").alias(key), F.col("shard"), F.col("slot").cast("bigint").alias("slot"))
    return keyed.join(places, key).select(*[quoted(c) for c in names], "shard", "slot")


def shard_documents(docs: DataFrame, n_shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """The digest table of op7: doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    It is placed as ``with_shards`` places the rows themselves, and needs no texts again."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("g"))
    out = assign(rows, n_shards, rounds)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query("op7_sharding")
def op7_sharding(spark, d):
    """Shard and slot of every document, law ``rows``, equal texts kept together where the counts allow."""
    return shard_documents(read(spark, d, "documents"))
