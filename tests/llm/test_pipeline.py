"""The pipeline's rows against its stages done by hand on the driver."""

from collections import Counter

import corpus_pipeline as P
from quarry.llm import langid_pieces as L
from quarry.llm.common import read

from .edge import documents, rows_of
from .test_decontaminate import brute as brute_hits
from .test_mixing import brute_targets
from .test_sharding import check
from .test_simhash import brute_components, brute_fingerprint


def test_run_against_brute_force(spark, sf):
    docs = read(spark, sf, "documents")
    pred = {r["doc_id"]: (r["_lang"], r["_score"]) for r in rows_of(L.identify(docs))}
    rows = [r for r in rows_of(docs) if pred[r["doc_id"]][0] != "und" and pred[r["doc_id"]][1] >= 0.5]
    root = brute_components([brute_fingerprint(r["text"]) for r in rows])
    first = {}
    for r, c in zip(rows, root):
        first[c] = min(first.get(c, r["doc_id"]), r["doc_id"])
    rows = [r for r in rows if r["doc_id"] in set(first.values())]
    bench = [(r["item_id"], r["text"]) for r in read(spark, sf, "benchmark").collect()]
    grams = {}
    for item, t in bench:
        grams.setdefault(item, []).append((item, t))
    text_of = " ".join
    from .test_decontaminate import words

    windows = {text_of(w[i : i + min(10, len(w))]) for _, t in bench if (w := words(t)) for i in range(len(w) - min(10, len(w)) + 1)}
    sizes = {len(w.split(" ")) for w in windows}
    clean = [r for r in rows if not any(text_of(w[i : i + k]) in windows for w in [words(r["text"])] for k in sizes for i in range(len(w) - k + 1))]
    assert 0 < len(clean) < len(rows)
    size = {r["doc_id"]: len(r["text"].split()) for r in clean}
    total = Counter()
    for r in clean:
        total[r["source"]] += size[r["doc_id"]]
    target = brute_targets(dict(total))
    out = rows_of(P.run(spark, sf))
    copies = Counter(r["doc_id"] for r in out)
    assert set(copies) <= {r["doc_id"] for r in clean}
    for r in clean:
        rate = target[r["source"]] / total[r["source"]]
        assert int(rate) <= copies[r["doc_id"]] <= int(rate) + 1
    check(out, sum(copies.values()))
    assert brute_hits("", bench) == (0, 0, [])


def test_stages_keep_columns_and_edges(spark):
    docs = documents(spark)
    bench_dir = "/root/testdata/sf0.001"
    cur = docs
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, cur, bench_dir)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), bench_dir).count() == 0, name
        cur = P.stored(out, "test")
    assert P.STAGES[-1][1](spark, docs.limit(0), bench_dir).count() == 0
    assert [n for n, _ in P.STAGES] == ["language", "near_duplicates", "decontamination", "source_mix", "shards"]


def test_last_stage_hands_on_the_documents(spark):
    docs = documents(spark, clash=False).unionByName(documents(spark, clash=False))
    out = P.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
    assert out.columns == [*docs.columns, "shard", "slot"]
    assert Counter(tuple(r[c] for c in docs.columns) for r in rows_of(out)) == Counter(tuple(r.values()) for r in rows_of(docs))
