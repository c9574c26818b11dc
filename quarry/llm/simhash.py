"""SimHash near-duplicates: fingerprints, then a self-join of their binary trie.

Fingerprints: one pass over whole texts in Arrow batches; equal ones are joined
into one node (with their smallest doc_id) before anything is compared.

Self-join: a pair at ``k`` or fewer differing bits agrees on ``2`` whole blocks
of the ``k + 2`` blocks its 64 bits are cut into. For each choice of two blocks
Spark deals the fingerprints, those blocks moved to the front, by that prefix
and sorts them inside the partition; a sorted run is a binary trie whose nodes
are index ranges. Node pairs start as (run, run) with no error spent; every
step splits both nodes by the next bit, adds one error to the mixed pairs and
prunes those beyond ``k``. A stack of bounded pieces keeps memory flat, and a prefix
that more than ``LONGEST`` fingerprints share is dealt on by two blocks of its other
bits. Inside a task a union-find drops links between nodes already joined
and node pairs that lie wholly in one joined set, so a task returns a spanning
forest, at most one link per fingerprint, not all pairs. The links meet in
connected components on Spark.

Null and empty texts have fingerprint zero and link like any other. Repeated
rows and ties share a fingerprint. A null doc_id never names a component unless
no other id is reachable. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache, partial
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import connected_components, fields_of, quoted, read, salt_of, salts_for, stored, whole_rows, with_least
from quarry.llm.registry import query

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SALTS = 64  # at least; the number grows with the rows
LONGEST = 1 << 20  # fingerprints of one prefix in a task
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash as a signed integer."""
    import xxhash

    if not text:
        return 0
    w = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w]) - 1
    k = min(shingle, len(w))
    starts = np.concatenate(([0], ends[: len(w) - k] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist())], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 8192):
        ones += np.unpackbits(h[i : i + 8192].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h)).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp bigint")


def _cut(bits: list[int], n: int) -> list[list[int]]:
    return [bits[len(bits) * i // n : len(bits) * (i + 1) // n] for i in range(n)]


@lru_cache(1 << 16)
def _layout(k: int, level: int, at: int) -> tuple[list[int], int]:
    """Choice ``at`` of two of ``k + 2`` blocks: the order of the 64 bits with those first, and how many they are.

    On a further level ``at // picks`` is the choice before, whose other bits are cut again."""
    pairs = list(combinations(range(k + 2), 2))
    order, done = _layout(k, level - 1, at // len(pairs)) if level > 1 else (list(range(64)), 0)
    blocks = _cut(order[done:], k + 2)
    front = order[:done] + [b for i in pairs[at % len(pairs)] for b in blocks[i]]
    return front + [b for b in order[done:] if b not in front], len(front)


def _shortest(k: int, level: int) -> int:
    """Bits that any two fingerprints of one run share on this level, at least."""
    done = _shortest(k, level - 1) if level > 1 else 0
    return done + sum(sorted(len(b) for b in _cut(list(range(64 - done)), k + 2))[:2])


class _Forest:
    """Union-find over 0..n-1 with vectorised flattening."""

    def __init__(self, n: int):
        self.p = np.arange(n)

    def flat(self) -> np.ndarray:
        while True:
            q = self.p[self.p]
            if np.array_equal(q, self.p):
                return q
            self.p = q

    def join(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        made, p = [], self.p
        for x, y in zip(a.tolist(), b.tolist()):
            u, v = x, y
            while p[u] != u:
                p[u] = p[p[u]]
                u = p[u]
            while p[v] != v:
                p[v] = p[p[v]]
                v = p[v]
            if u != v:
                p[max(u, v)] = min(u, v)
                made.append((x, y))
        return made


def trie_links(keys: np.ndarray, prefix: int, k: int, piece: int = 1 << 18) -> list[tuple[int, int]]:
    """A spanning forest of the links among sorted distinct uint64 ``keys`` that
    agree on their first ``prefix`` bits and differ in ``k`` bits or fewer."""
    n = len(keys)
    if n < 2:
        return []
    top = keys >> np.uint64(64 - prefix) if prefix else np.zeros(n, np.uint64)
    start = np.flatnonzero(np.concatenate(([True], top[1:] != top[:-1])))
    stop = np.concatenate((start[1:], [n]))
    many = stop - start > 1
    start, stop = start[many], stop[many]
    forest, links = _Forest(n), []
    pending = [(prefix, start, stop, start, stop, np.zeros(len(start), np.int8))]
    while pending:
        bit, al, ah, bl, bh, err = pending.pop()
        if len(al) > piece:  # depth first in bounded pieces
            for i in range(0, len(al), piece):
                pending.append((bit, *(x[i : i + piece] for x in (al, ah, bl, bh, err))))
            continue
        # node pairs that already lie in one joined set bring nothing new
        root = forest.flat()
        step = np.concatenate(([0], np.cumsum(root[1:] != root[:-1])))
        same = (step[al] == step[ah - 1]) & (step[bl] == step[bh - 1]) & (root[al] == root[bl])
        al, ah, bl, bh, err = (x[~same] for x in (al, ah, bl, bh, err))
        # pairs of single leaves are settled by counting the bits that differ
        leaf = (ah - al == 1) & (bh - bl == 1)
        if leaf.any():
            a, b = al[leaf], bl[leaf]
            near = np.bitwise_count(keys[a] ^ keys[b]) <= k
            links += forest.join(a[near], b[near])
            al, ah, bl, bh, err = (x[~leaf] for x in (al, ah, bl, bh, err))
        if not len(al) or bit == 64:
            continue
        mask = np.uint64(1 << (63 - bit))
        am, bm = _split(keys, al, ah, mask), _split(keys, bl, bh, mask)
        own = al == bl  # a node with itself: its two halves meet once
        nxt = []
        for (xl, xh), (yl, yh), cost, skip in (((al, am), (bl, bm), 0, None), ((am, ah), (bm, bh), 0, None), ((al, am), (bm, bh), 1, None), ((am, ah), (bl, bm), 1, own)):
            ok = (xh > xl) & (yh > yl) & (err + cost <= k)
            if skip is not None:
                ok &= ~skip
            ok &= ~(own & (xl == yl) & (xh - xl == 1))  # a single leaf with itself
            nxt.append((xl[ok], xh[ok], yl[ok], yh[ok], (err[ok] + cost).astype(np.int8)))
        pending.append((bit + 1, *(np.concatenate(c) for c in zip(*nxt))))
    return links


def _split(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, mask) -> np.ndarray:
    """First index in [lo, hi) whose ``mask`` bit is set: a binary search over all ranges at once."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        one = (keys[np.minimum(mid, len(keys) - 1)] & mask) != 0
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)


def _permuted(v: np.ndarray, order: list[int]) -> np.ndarray:
    """Bits of ``v`` (bit 0 is the highest) in the given order, moved run by run."""
    out = np.zeros_like(v)
    i = 0
    while i < 64:
        j = i
        while j + 1 < 64 and order[j + 1] == order[j] + 1:
            j += 1
        width = j - i + 1
        m = np.uint64((1 << width) - 1)
        out |= ((v >> np.uint64(64 - order[i] - width)) & m) << np.uint64(64 - i - width)
        i = j + 1
    return out


def links(fps: DataFrame, k: int = MAX_BITS, rows_at_once: int = 1 << 18, longest: int = LONGEST) -> DataFrame:
    """(a, b) links among distinct fingerprints ``fp``: spanning forests of each task's near pairs.

    Fingerprints that may lie in a run of over ``longest`` are dealt on by two blocks
    of the run's other bits, again and again, until no run is longer or its bits end."""
    level, picks = 1, comb(k + 2, 2)
    rows, count = fps.select(F.lit(0).alias("t"), "fp"), fps.count()
    found = None
    while True:
        shortest = _shortest(k, level)
        dealt = rows.mapInArrow(partial(_deal, k=k, level=level), "t int, key bigint, fp bigint")
        hot = None
        if count > longest and 1 << (64 - shortest) > longest and 64 - shortest >= 2 * (k + 2):
            # counts by the first bits of the keys, about 16 buckets for each run that could be too long
            shift = max(0, shortest - (16 * count * picks // longest).bit_length())
            dealt = dealt.withColumn("bucket", F.shiftright("key", shift))
            counts = stored(dealt.groupBy("t", "bucket").agg(F.count("*").alias("n")).where(F.col("n") > longest), "fpruns")
            runs, count = counts.agg(F.count("*"), F.sum("n")).first()
            hot = counts.select("t", "bucket") if runs else None
            if runs and runs <= 100_000:
                hot = F.broadcast(hot)
        cool = dealt if hot is None else dealt.join(hot, ["t", "bucket"], "left_anti")
        runs_of = cool.select("t", "key", "fp").repartition("t", "key").sortWithinPartitions("t", "key")
        step = runs_of.mapInArrow(partial(_walk, k=k, level=level, rows_at_once=rows_at_once), "a bigint, b bigint")
        found = step if found is None else found.unionByName(step)
        if hot is None:
            return found
        rows, level = stored(dealt.join(hot, ["t", "bucket"], "left_semi").select("t", "fp"), "fpcrowd"), level + 1


def _deal(batches, k: int, level: int):
    """Each (t, fp) once for every choice of two further blocks."""
    picks = comb(k + 2, 2)
    for b in batches:
        t, v = b.column("t").to_numpy(zero_copy_only=False), b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for before in np.unique(t).tolist():
            own = v[t == before]
            for at in range(before * picks, (before + 1) * picks):
                order, front = _layout(k, level, at)
                key = (_permuted(own, order) >> np.uint64(64 - front)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), at, np.int32)), pa.array(key), pa.array(own.view(np.int64))], ["t", "key", "fp"])


def _walk(batches, k: int, level: int, rows_at_once: int):
    """Whole runs of (t, key) at a time; a run goes over as many batches as it needs."""
    def joined(t, fp):
        a, b = [], []
        for each in np.unique(t):
            own = fp[t == each]
            order, front = _layout(k, level, int(each))
            keys = _permuted(own.view(np.uint64), order)
            up = np.argsort(keys)
            keys, own = keys[up], own[up]
            for x, y in trie_links(keys, front, k):
                a.append(int(own[x]))
                b.append(int(own[y]))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    held, rows, wait = [], 0, rows_at_once
    for batch in batches:
        held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        rows += batch.num_rows
        if rows < wait:
            continue
        t, key, fp = (np.concatenate(c) for c in zip(*held))
        end = int(np.count_nonzero((t != t[-1]) | (key != key[-1])))  # sorted: the last run is the tail
        if end:
            yield joined(t[:end], fp[:end])
        held, rows = [[t[end:], key[end:], fp[end:]]], len(t) - end
        wait = max(rows_at_once, 2 * rows)
    if rows:
        t, _, fp = (np.concatenate(c) for c in zip(*held))
        yield joined(t, fp)


def _rooted(docs: DataFrame, shingle: int, k: int) -> DataFrame:
    """(doc_id, fp, component_id, root): one row per document row; root is a fingerprint and tells components without any id apart."""
    each = stored(fingerprints(docs, shingle), "fp")
    salts = salts_for(each.count(), SALTS)
    each = each.withColumn("_salt", salt_of("doc_id", buckets=salts))
    parts = stored(each.groupBy("fp", "_salt").agg(F.min("doc_id").alias("first_id")), "fpparts")
    nodes = stored(parts.groupBy("fp").agg(F.min("first_id").alias("first_id")), "fpnodes")
    roots = connected_components(links(nodes, k))
    # only fingerprints with a near partner need the join to their component
    members = roots.select(F.col("node").alias("fp"), "root").join(nodes, "fp")
    linked = with_least(members, "root", "first_id", "component_id", "fp", salts).select("fp", "component_id", "root")
    named = nodes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"), F.coalesce("root", "fp").alias("root"))
    # names reach the rows per (fingerprint, salt): a text that a third of all rows share is many join keys
    return each.join(parts.select("fp", "_salt").join(named, "fp"), ["fp", "_salt"]).select("doc_id", "fp", "component_id", "root")


def components(docs: DataFrame, shingle: int = SHINGLE, k: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id): one row per document row."""
    return _rooted(docs, shingle, k).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, k: int = MAX_BITS, broadcast_ids: int = 2_000_000) -> DataFrame:
    """One document of each group, the one whose id names the component, with all columns.

    Equal rows of that id are copies: one stays. Rows of one id with different
    texts stay in the group that the id names, and go from any other. A group
    without an id keeps one row, the one with the smallest text hash."""
    groups = _rooted(docs, shingle, k)
    names = F.col("doc_id") == F.col("component_id")
    per_id = stored(groups.where("doc_id is not null").groupBy("doc_id").agg(F.bool_and(names).alias("all_stay"), F.bool_or(names).alias("some_stay"), F.count("*").alias("n")), "fpkeep")
    part = F.col("some_stay") & ~F.col("all_stay")
    gone, parted, again = per_id.agg(F.count_if(~F.col("all_stay")), F.count_if(part), F.count_if(F.col("n") > 1)).first()
    small = lambda ids, n: F.broadcast(ids) if n <= broadcast_ids else ids
    drop = per_id.where(~F.col("all_stay")).select(F.col("doc_id").alias("_gone"))
    whole = whole_rows(docs, doc_id=quoted("doc_id"), text=quoted("text"))
    kind = whole.schema["row"].dataType.simpleString()
    # equal rows: by the whole row, or by its text form where a map in it cannot be compared
    same = F.sha2(F.to_json("row"), 256) if "map<" in kind else F.col("row")
    once = lambda rows: rows.withColumn("same", same).dropDuplicates(["same"]).drop("same")
    named = whole.where("doc_id is not null")
    kept = named.join(small(drop, gone), F.col("doc_id") == F.col("_gone"), "left_anti")

    @F.pandas_udf("bigint")
    def printed(s: pd.Series) -> pd.Series:
        return s.map(lambda t: fingerprint(t, shingle))

    fp = printed(F.coalesce(F.col("text"), F.lit("")))
    if parted:  # ids that also occur in a group they do not name: row by row, by fingerprint
        ids = per_id.where(part).select(F.col("doc_id").alias("_parted"))
        stay = groups.where(names).select(F.col("doc_id").alias("_own"), F.col("fp").alias("_ownfp")).distinct()
        rows = named.join(small(ids, parted), F.col("doc_id") == F.col("_parted"), "left_semi").transform(once).withColumn("_fp", fp)
        kept = kept.unionByName(rows.join(stay, (F.col("doc_id") == F.col("_own")) & (F.col("_fp") == F.col("_ownfp")), "left_semi").drop("_fp"))
    kept = once(kept) if again else kept
    lone = stored(groups.where("doc_id is null and component_id is null").select(F.col("fp").alias("_lonefp"), F.col("root").alias("_root")).distinct(), "fplone")
    if lone.take(1):  # groups without an id: the smallest row of each fingerprint, then of each group
        rank = F.struct(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256), F.sha2(F.to_json("row"), 256))
        least = whole.where("doc_id is null").select(fp.alias("_fp"), F.col("row").alias("_row"), rank.alias("_rank"))
        least = least.groupBy("_fp").agg(F.min("_rank").alias("_rank"), F.min_by("_row", "_rank").alias("_row"))
        least = least.join(lone, F.col("_fp") == F.col("_lonefp")).groupBy("_root").agg(F.min_by("_row", "_rank").alias("_row"))
        kept = kept.select("row").unionByName(least.select(F.col("_row").alias("row")))
    return kept.select(*fields_of(docs))


@query("op6_simhash")
def op6_simhash(spark, d):
    """Fingerprint and near-duplicate component of every whole document."""
    c = components(read(spark, d, "documents"))
    return c.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
