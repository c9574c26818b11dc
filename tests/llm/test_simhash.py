import random
import re

import numpy as np
import pytest
import xxhash

from quarry.llm import simhash as H
from quarry.llm.common import connected_components, read, salts_for, with_least

from .edge import documents, rows_of


def brute_fingerprint(t, k=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, k=4):
    n, root = len(fps), list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    v = np.array(fps, np.uint64)
    for i in range(n):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1 :] ^ v[i]) <= k):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_fingerprint():
    for t in (None, "", " \n", "One", "a b c", "a b c d", "A b C d e É", "x y " * 500, "ß\u00a0ü \x1c z q w e r"):
        assert H.fingerprint(t) & (2**64 - 1) == brute_fingerprint(t), t


@pytest.mark.parametrize("prefix", [0, 3])
def test_trie_join_finds_every_component(prefix):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(120)]
    keys = set(base)
    for b in base[:60]:
        for _ in range(6):
            x = b
            for bit in r.sample(range(64), r.randint(1, 6)):
                x ^= 1 << bit
            keys.add(x)
    keys |= {b ^ d for b in base[:1] for d in range(400)}  # a dense group
    keys = np.array(sorted(keys), np.uint64)
    links = H.trie_links(keys, prefix, 4, piece=64)
    assert len(links) < len(keys)
    for a, b in links:
        assert int(keys[a] ^ keys[b]).bit_count() <= 4
    top = (keys >> np.uint64(64 - prefix) if prefix else np.zeros(len(keys), np.uint64)).tolist()
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    if not prefix:
        assert [find(i) for i in range(len(keys))] == brute_components(keys.tolist())
    else:  # within each prefix
        for t in set(top):
            at = [i for i, x in enumerate(top) if x == t]
            want = brute_components([int(keys[i]) for i in at])
            same = {(find(a), want[x]) for x, a in enumerate(at)}
            assert len(same) == len({w for _, w in same}) == len({f for f, _ in same})


def test_links_reach_every_pair(spark):
    r = random.Random(9)
    fps = set()
    for _ in range(150):
        b = r.getrandbits(64)
        fps.add(b)
        x = b
        for bit in r.sample(range(64), 4):
            x ^= 1 << bit
        fps.add(x)
    signed = [f - 2**64 if f >> 63 else f for f in sorted(fps)]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    got = connected_components(H.links(df, rows_at_once=50))
    roots = {x["node"]: x["root"] for x in got.collect()}
    comp = brute_components([f & (2**64 - 1) for f in signed])
    for i, f in enumerate(signed):
        for j in range(i):
            assert (comp[i] == comp[j]) == (roots.get(f, f) == roots.get(signed[j], signed[j]))


@pytest.mark.parametrize("longest", [60])
def test_long_runs_are_dealt_on(spark, longest):
    """Fingerprints crowded around a few centres: prefixes shared by more than a task takes, level after level."""
    r = random.Random(4)
    fps = {r.getrandbits(64) for _ in range(40)}
    for centre in (r.getrandbits(64), r.getrandbits(64), 0):
        for _ in range(130):
            x = centre
            for bit in r.sample(range(64), r.randint(0, 7)):
                x ^= 1 << bit
            fps.add(x)
    signed = [f - 2**64 if f >> 63 else f for f in sorted(fps)]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    comp = brute_components([f & (2**64 - 1) for f in signed])
    found = H.links(df, longest=longest).distinct().collect()
    assert all(((x["a"] ^ x["b"]) & (2**64 - 1)).bit_count() <= 4 for x in found)
    root = {f: f for f in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in found:
        a, b = find(x["a"]), find(x["b"])
        root[max(a, b)] = min(a, b)
    assert len({(find(f), c) for f, c in zip(signed, comp)}) == len({find(f) for f in signed}) == len(set(comp))


def test_layouts_of_further_levels():
    for level in (1, 2, 3):
        layouts = [H._layout(4, level, at) for at in range(0, 15**level, 7)]
        assert all(sorted(order) == list(range(64)) for order, _ in layouts)
        assert min(front for _, front in layouts) >= H._shortest(4, level)
    (a, n), (b, m) = H._layout(4, 1, 3), H._layout(4, 2, 3 * 15 + 8)
    assert a[:n] == b[:n] and m > n


def test_least_of_a_hot_key(spark):
    rows = [(1, i, 1000 - i) for i in range(900)] + [(k, k, k) for k in range(2, 40)] + [(50, 1, None), (50, 2, None)]
    df = spark.createDataFrame(rows, "g int, v int, x int")
    got = sorted((x["g"], x["v"], x["x"] or 0, x["low"]) for x in with_least(df, "g", "x", "low", "v", salts_for(len(rows))).collect())
    assert got == sorted((g, v, x or 0, {1: 101, 50: None}.get(g, g)) for g, v, x in rows)


def test_components_of_whole_table(spark, sf):
    rows = read(spark, sf, "documents").select("doc_id", "text").collect()
    fps = [brute_fingerprint(r["text"]) for r in rows]
    root = brute_components(fps)
    first = {}
    for r, c in zip(rows, root):
        first[c] = min(first.get(c, r["doc_id"]), r["doc_id"])
    want = {(r["doc_id"], f, first[c]) for r, f, c in zip(rows, fps, root)}
    got = {(r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in rows_of(H.components(read(spark, sf, "documents")))}
    assert got == want


def test_edges(spark):
    docs = documents(spark)
    got = rows_of(H.components(docs))
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["fp"], r["component_id"]))
    assert by[3] == by[4] == by[5] == {(0, 3)}
    assert by[1] == by[2] and next(iter(by[1]))[1] == 1
    assert H.components(docs.limit(0)).count() == 0
    kept = H.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in rows_of(kept)) == [0, 1, 3, 6, 7, 8, 9]
    same = documents(spark, [(2, "a b c d e", "en", "s")] * 3)
    assert H.keep_one(same).count() == 1
    assert sorted(r["doc_id"] or 0 for r in rows_of(H.keep_one(docs, broadcast_ids=-1))) == [0, 1, 3, 6, 7, 8, 9]
    assert H.keep_one(docs.limit(0)).count() == 0


def test_connected_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5000, 5000 + i) for i in range(1, 300)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {x["node"]: x["root"] for x in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {v: find(v) for a, b in edges for v in (a, b) if a != b}


def test_keep_one_decides_per_row_and_group(spark):
    """Rows without an id and ids that repeat: one document of each group stays, and none of a group that another id names."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [
        (1, a, "en", "s"), (None, a, "en", "s"), (5, a, "en", "s"), (5, b, "en", "s"), (6, b, "en", "s"),  # 5 names b's group and is foreign in a's
        (None, c, "en", "s"), (None, c, "en", "s"), (None, c, "en", "t"), (None, d, "en", "s"), (None, d, "en", "s"), (9, "x y z", "en", "s"), (9, "x y z", "en", "s"),
    ]
    for limit in (2_000_000, 0):
        got = [tuple(r.values())[:3] for r in rows_of(H.keep_one(documents(spark, rows, clash=False), broadcast_ids=limit))]
        assert sorted(got, key=str) == sorted([(1, a, "en"), (5, b, "en"), (None, c, "en"), (None, d, "en"), (9, "x y z", "en")], key=str)
