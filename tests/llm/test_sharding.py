import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from quarry.llm import sharding as S
from quarry.llm.common import read

from .edge import documents, rows_of


def check(out, n, shards=8):
    count = Counter(r["shard"] for r in out)
    assert len(out) == n and set(count) <= set(range(shards))
    assert max(count.values(), default=0) - min((count.get(s, 0) for s in range(shards)), default=0) <= 1
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def split_groups(rows, shard):
    by = defaultdict(set)
    for r in rows:
        by[r["text_crc32"], r["size"]].add(r[shard])
    return sum(len(s) > 1 for s in by.values())


def test_law_rows_and_cut(spark, sf):
    docs = read(spark, sf, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = rows_of(S.shard_documents(docs).withColumn("first", F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(8))))
    check(out, len(texts))
    for r in out:
        raw = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw) and r["law"] == "rows" and r["grown_shard"] is None
    assert split_groups(out, "shard") <= split_groups(out, "first") / 4


def test_hot_group_spans_as_few_shards_as_it_must(spark):
    rows = [(i, "hot", "en", "a") for i in range(800)] + [(1000 + i, f"t{i // 2}", "en", "a") for i in range(400)] + [(2000 + i, f"u{i}", "en", "a") for i in range(803)]
    out = rows_of(S.shard_documents(documents(spark, rows)))
    check(out, len(rows))
    where = Counter(r["shard"] for r in out if r["doc_id"] < 1000)
    assert len(where) <= 5  # 800 of 2003 rows: four shards of 250 at least
    pairs = defaultdict(set)
    for r in out:
        if 1000 <= r["doc_id"] < 2000:
            pairs[(r["doc_id"] - 1000) // 2].add(r["shard"])
    assert sum(len(s) > 1 for s in pairs.values()) <= 20


def test_all_rows_linked(spark):
    rows = [(i, f"t{i // 10}", "en", "a") for i in range(1001)]
    out = rows_of(S.shard_documents(documents(spark, rows)))
    check(out, 1001)
    assert split_groups(out, "shard") <= 30


def test_edges(spark):
    docs = documents(spark)
    check(rows_of(S.shard_documents(docs)), docs.count())
    assert S.shard_documents(docs.limit(0)).count() == 0
    one = documents(spark, [(2, "same", "en", "s")] * 20)
    check(rows_of(S.shard_documents(one)), 20)
    check(rows_of(S.shard_documents(documents(spark, [(None, None, None, None)] * 9), n_shards=3)), 9, 3)


def test_quotas_keep_capacities():
    asked = {(0, 1): 50, (1, 0): 20, (2, 1): 40, (1, 2): 5}
    give = S.quotas(asked, [100, 100, 60], [100, 110, 100])
    assert all(0 <= give[k] <= asked[k] for k in asked)
    size = [100, 100, 60]
    for (i, j), n in give.items():
        size[i] -= n
        size[j] += n
    assert all(s <= c for s, c in zip(size, [100, 110, 100]))
    assert give[0, 1] >= 20 and give[1, 0] == 20


def test_any_number_of_rank_buckets(spark, monkeypatch):
    """Tables of billions of rows rank in more buckets: the law, the slots and the links hold with any number."""
    rows = [(i, "hot", "en", "a") for i in range(300)] + [(1000 + i, f"t{i // 3}", "en", "a") for i in range(300)] + [(2000 + i, f"u{i}", "en", "a") for i in range(203)]
    assert S.buckets_for(10**10, 256) == 9536 and S.buckets_for(1000, 256) == 256
    for n in (1, 500):
        monkeypatch.setattr(S, "buckets_for", lambda total, least, each=0, n=n: n)
        out = rows_of(S.shard_documents(documents(spark, rows)))
        check(out, len(rows))
        where = Counter(r["shard"] for r in out if r["doc_id"] < 1000)
        assert len(where) <= 4  # 300 of 803 rows: three shards of 100 at least


def test_rows_come_back_whole(spark):
    """Every column of every row, where ids and whole rows repeat as after the mix."""
    rows = [(i // 3, f"text {i // 6}", "en", f"s{i % 2}") for i in range(400)] + [(7, "same", "en", "a")] * 60 + [(None, None, None, None)] * 9
    docs = documents(spark, rows, clash=False)
    out = S.with_shards(docs)
    assert out.columns == [*docs.columns, "shard", "slot"]
    got = rows_of(out)
    check(got, len(rows))
    assert Counter(tuple(r[c] for c in docs.columns) for r in got) == Counter(rows)
    clash = documents(spark)
    back = S.with_shards(clash)
    assert set(back.columns) == set(clash.columns) and back.count() == clash.count() and S.with_shards(clash.limit(0)).count() == 0
    assert all(r["g"] == r["size"] == "kept" for r in rows_of(back))
