"""Merkle manifest of a dataset: a digest tree, and for every row a proof that is climbed again.

A leaf is the SHA-256 of a row's five columns; the leaves of a source, in order
of their ids, form a tree of runs of ``FAN`` nodes, and the sources' subroots
form one tree above them. The built levels are stored as parent-linked rows, two
levels in each: up to nine digests, the up to three of the level between (none
where one level is left), and the row and slot that the row's own digest goes to.

The climb is one recursive query: a climber per leaf starts with its (perhaps
tampered) digest; every step joins the row it stands in, appends the siblings of
both levels there, and folds its digest with them into the row's. The siblings of
a step leave with that step's row and are put together once at the end, so a
climber stays small however high the tree. All leaves of a source pass the same
few upper rows; those are stored once per ``CHUNK`` leaves below them and joined
by chunk too, so no key has more than ``CHUNK`` climbers.

Null values are leaves of their own kind (``-``); null ids come first; rows of
one id go by leaf digest, and equal rows are interchangeable. Long texts are
hashed whole. Columns beside the five are not read, whatever their names. A
table of one row has an empty proof and its leaf as root; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import read, stored
from quarry.llm.registry import query

FAN = 3
SPAN = FAN * FAN  # two levels in each step
CHUNK_STEPS = 4
CHUNK = SPAN**CHUNK_STEPS  # climbers per join key
ROWS_PER_RANGE = 500_000
# A place: (step, 64 more in the tree over the sources) x 2^52 + row x 16 + slot, so places ascend on the way up.
STEP_BITS, SLOT_BITS, ABOVE = 52, 4, 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _digest(c: Column) -> Column:
    return F.unhex(F.sha2(c, 256))


def _hex(c: Column) -> Column:
    return F.lower(F.hex(c))


def encoded(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(text: Column, columns=COLUMNS) -> Column:
    return _digest(F.concat(*[encoded(text if c == "text" else F.col(c)) for c in columns]))


def without_line_ends(doc_id: Column, text: Column) -> Column:
    """The contract's tampering: every second checksum of an id loses the text's line feeds."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(hit & F.contains(text, F.lit("\n")), F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def numbered(df: DataFrame, order: list[Column], rows: int, name: str, out: str) -> DataFrame:
    """``df`` with its place 0.. in ``order``, stored: ranges sorted on their own, then offset by the rows before them."""
    spark = df.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_RANGE)) if rows > 10_000 else 1
    # equal rows are told apart by where they are read, so that ranges can be cut between them
    tied = df.withColumn("tie_", F.monotonically_increasing_id())
    keys = [*order, F.col("tie_").asc()]
    placed = tied.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).drop("tie_").withColumn("place_", F.monotonically_increasing_id())
    placed = stored(placed, name).withColumn("range_", F.shiftright("place_", 33))
    before = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    offsets = placed.groupBy("range_").agg(F.count("*").alias("n_")).select("range_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("before_"))
    return placed.join(F.broadcast(offsets), "range_").withColumn(out, F.col("before_") + F.col("place_").bitwiseAND((1 << 33) - 1)).drop("range_", "place_", "before_")


def _joined(digests: Column) -> Column:
    """Digests as one binary."""
    return F.unhex(F.array_join(F.transform(digests, F.hex), ""))


def _run_digest(digests: Column) -> Column:
    return _digest(_hex(_joined(digests)))


def levels(nodes: DataFrame, most: int, name: str) -> list[DataFrame]:
    """Two levels at a time from (tree, n, pos, digest), n being the nodes of the tree:
    (tree, n, pos, kids, mids, digest), n counting what is left."""
    out = []
    while most > 1:
        n = F.col("n")
        rows = nodes.where(n > 1).groupBy("tree", "n", F.floor(F.col("pos") / SPAN).cast("bigint").alias("up")).agg(F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("c"))
        kids = F.transform("c", lambda x: x["digest"])
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size("c") - 1) / FAN).cast("int")), lambda i: _run_digest(F.slice("k", i * FAN + 1, F.lit(FAN))))
        rows = rows.withColumn("k", kids).withColumn("m", F.when(n > FAN, runs))
        digest = F.when(n > FAN, _run_digest(F.col("m"))).otherwise(_run_digest(F.col("k")))
        rows = rows.select("tree", F.ceil(n / SPAN).cast("bigint").alias("n"), F.col("up").alias("pos"), _joined(F.col("k")).alias("kids"), _joined(F.col("m")).alias("mids"), digest.alias("digest"))
        nodes = stored(rows, f"{name}-{len(out) + 1}")
        out.append(nodes)
        most = -(-most // SPAN)
    return out


def _place(step: int, pos: Column) -> Column:
    """The place in its row of the node ``pos`` that enters ``step``."""
    row, slot = F.floor(pos / SPAN).cast("bigint"), F.pmod(pos, F.lit(SPAN))
    return F.lit(step << STEP_BITS).cast("bigint") + F.shiftleft(row, SLOT_BITS) + slot


def _row(step: int, pos: Column) -> Column:
    """The number by which climbers find the row ``pos`` of ``step``."""
    return F.lit(step << (STEP_BITS - SLOT_BITS)).cast("bigint") + pos


def _in_chunks(rows: DataFrame, step: int) -> DataFrame:
    """A source's rows of one step, once per chunk of leaves below them (``leaves``: those of the tree)."""
    if step <= CHUNK_STEPS:
        return rows.withColumn("chunk", F.floor(F.col("pos") / SPAN ** (CHUNK_STEPS - step)).cast("bigint"))
    span = SPAN ** (step - CHUNK_STEPS)
    last = F.floor((F.col("leaves") - 1) / CHUNK).cast("bigint")
    return rows.withColumn("chunk", F.explode(F.sequence(F.col("pos") * span, F.least((F.col("pos") + 1) * span - 1, last))))


def manifest(docs: DataFrame, tampered: Column | None = None, broadcast_sources: int = 100_000) -> DataFrame:
    """(doc_id, tree, pos, leaf, subroot, root, siblings, folded): digests as binary,
    siblings level by level from the leaf's run upwards, joined into one binary,
    folded being the root recomputed from the leaf of the ``tampered`` text and the
    stored siblings; tree is the rank of the source's first leaf, pos the leaf's place in it."""
    spark = docs.sparkSession
    own, other = leaf_digest(F.col("text")), leaf_digest(F.col("text") if tampered is None else tampered)
    changed = F.lit(None).cast("binary") if tampered is None else F.when(~tampered.eqNullSafe(F.col("text")), other)
    leaves = docs.select("doc_id", "source", own.alias("leaf"), changed.alias("forged"))
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()]
    ranked = numbered(leaves, order, docs.count(), "merkle-leaves", "rank")
    sources = stored(ranked.groupBy("source").agg(F.min("rank").alias("tree"), F.count("*").alias("leaves")), "merkle-sources")
    n_sources, most = sources.agg(F.count("*"), F.coalesce(F.max("leaves"), F.lit(0))).first()
    sources = stored(numbered(sources, [F.col("tree").asc()], n_sources, "merkle-order", "place"), "merkle-trees")
    small = F.broadcast if n_sources <= broadcast_sources else lambda x: x
    hint = small(sources.withColumnRenamed("source", "of"))
    placed = ranked.join(hint, F.col("source").eqNullSafe(F.col("of"))).select("doc_id", "leaf", "forged", "tree", "leaves", "place", (F.col("rank") - F.col("tree")).alias("pos"))
    placed = stored(placed, "merkle-placed")

    below = levels(placed.select("tree", F.col("leaves").alias("n"), "pos", F.col("leaf").alias("digest")), most, "merkle-level")
    subroots = placed.where("leaves = 1").select("tree", F.col("leaf").alias("subroot"))
    for rows in below:
        subroots = subroots.unionByName(rows.where("n = 1").select("tree", F.col("digest").alias("subroot")))
    tops = stored(sources.join(subroots, "tree"), "merkle-subroots")
    above = levels(tops.select(F.lit(-1).cast("bigint").alias("tree"), F.lit(n_sources).cast("bigint").alias("n"), F.col("place").alias("pos"), F.col("subroot").alias("digest")), n_sources, "merkle-top")
    root = (above[-1].select("digest") if above else tops.select(F.col("subroot").alias("digest"))).first()
    root = F.lit(bytes(root[0]) if root else None).cast("binary")

    to_top = F.when(F.lit(n_sources > 1), _place(ABOVE + 1, F.col("place")))
    linked = None
    for step, each in enumerate(below, 1):
        rows = _in_chunks(each.join(small(sources.select("tree", "place", "leaves")), "tree"), step)
        rows = rows.select("tree", "chunk", _row(step, F.col("pos")).alias("row"), "kids", "mids", F.when(F.col("n") > 1, _place(step + 1, F.col("pos"))).otherwise(to_top).alias("up"))
        linked = rows if linked is None else linked.unionByName(rows)
    chunks = sources.select("place", F.col("tree").alias("of"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("leaves") - 1) / CHUNK).cast("bigint"))).alias("chunk"))
    for step, each in enumerate(above, 1):
        span = SPAN**step
        within = each.withColumn("place", F.explode(F.sequence(F.col("pos") * span, F.least((F.col("pos") + 1) * span, F.lit(n_sources).cast("bigint")) - 1)))
        rows = within.join(small(chunks), "place")
        rows = rows.select(F.col("of").alias("tree"), "chunk", _row(ABOVE + step, F.col("pos")).alias("row"), "kids", "mids", F.when(F.col("n") > 1, _place(ABOVE + step + 1, F.col("pos"))).alias("up"))
        linked = rows if linked is None else linked.unionByName(rows)
    start = placed.select("tree", "pos", F.when(F.col("leaves") > 1, _place(1, F.col("pos"))).otherwise(to_top).alias("at"), F.coalesce("forged", "leaf").alias("folded"))
    names = placed.select("doc_id", "leaf", "tree", "pos")
    subroot = small(tops.select("tree", "subroot"))
    if linked is None:  # one leaf
        return names.join(start, ["tree", "pos"]).join(subroot, "tree").select("doc_id", "tree", "pos", "leaf", "subroot", root.alias("root"), F.lit(b"").alias("siblings"), "folded")
    return _climb(start, stored(linked, "merkle-rows"), names, subroot).select("doc_id", "tree", "pos", "leaf", "subroot", root.alias("root"), "siblings", "folded")


# In a row of joined digests: the one of a slot replaced, and the others of its run.
_PUT = "concat(substring({0}, 1, 32 * ({1})), {2}, substring({0}, 32 * ({1}) + 33))"
_OTHERS = "concat(substring({0}, 1, 32 * ({1})), substring({0}, 32 * ({1}) + 33))"
_FOLD = "unhex(sha2(lower(hex({0})), 256))"


def _climb(start: DataFrame, rows: DataFrame, names: DataFrame, subroot: DataFrame) -> DataFrame:
    """Every leaf's way up by one recursive query, then its siblings in order and its folded digest, stored."""
    spark = start.sparkSession
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    run = "substring(r.kids, 96 * (c.slot div 3) + 1, 96)"
    lower = _FOLD.format(_PUT.format(run, "c.slot % 3", "c.folded"))
    spark.conf.set(limit, "-1")  # every leaf climbs: the default ends at a million rows
    try:
        steps = spark.sql(
            f"""
            WITH RECURSIVE climb AS (
              SELECT tree, pos, at, folded, cast(null AS binary) AS siblings FROM {{start}}
              UNION ALL
              SELECT c.tree, c.pos, r.up,
                if(r.mids is null, {lower}, {_FOLD.format(_PUT.format("r.mids", "c.slot div 3", lower))}),
                concat({_OTHERS.format(run, "c.slot % 3")}, if(r.mids is null, x'', {_OTHERS.format("r.mids", "c.slot div 3")}))
              FROM (SELECT tree, pos, cast(pos div {CHUNK} AS bigint) AS chunk, shiftright(at, {SLOT_BITS}) AS row, cast(at & {2**SLOT_BITS - 1} AS int) AS slot, folded FROM climb WHERE at is not null) c
              JOIN {{rows}} r ON c.tree = r.tree AND c.chunk = r.chunk AND c.row = r.row
            )
            SELECT tree, pos, coalesce(at, {2**63 - 1}) AS at, if(at is null, folded, null) AS folded, siblings FROM climb""",
            start=start,
            rows=rows,
        )
        paths = steps.groupBy("tree", "pos").agg(F.max("folded").alias("folded"), F.array_sort(F.collect_list(F.when(F.col("siblings").isNotNull(), F.struct("at", "siblings")))).alias("s"))
        paths = paths.select("tree", "pos", "folded", F.unhex(F.array_join(F.transform("s", lambda x: F.hex(x["siblings"])), "")).alias("siblings"))
        return stored(names.join(paths, ["tree", "pos"]).join(subroot, "tree"), "merkle-climb")
    finally:
        if before is None:
            spark.conf.unset(limit)
        else:
            spark.conf.set(limit, before)


_ORACLE = """WITH RECURSIVE crc AS (
  SELECT DISTINCT doc_id, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda ch: list_transform(range(8), lambda b: ((ascii(ch)::BIGINT >> b) & 1))))),
    lambda c, b: xor(c >> 1, CASE WHEN (xor(c, b) & 1) = 1 THEN 3988292384 ELSE 0 END)) AS c FROM documents),
enc AS (
  SELECT d.doc_id, d.source, rowid_,
    coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    text, CASE WHEN (c.c & 1) = 1 THEN replace(text, chr(10), '') ELSE text END AS forged
  FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents) d LEFT JOIN crc c ON c.doc_id = d.doc_id),
leaf AS (
  SELECT doc_id, source, rowid_, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(forged) || ':' || forged, '-')) AS bad FROM enc),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaf),
node AS (
  SELECT 0 AS lvl, s, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT lvl + 1, s, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM node WHERE n > 1 GROUP BY lvl, s, pos // 3, n),
subroot AS (SELECT s, lvl, h, count(*) OVER () AS n FROM node WHERE n = 1),
top AS (
  SELECT 0 AS lvl, s AS pos, n, h FROM subroot
  UNION ALL
  SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 3, n),
nodes AS (
  SELECT s, lvl, pos, n, h FROM node WHERE n > 1
  UNION ALL SELECT -1, lvl, pos, n, h FROM top),
climb AS (
  SELECT rowid_, s AS src, CASE WHEN n > 1 THEN s ELSE -1 END AS t, 0 AS lvl, CASE WHEN n > 1 THEN pos ELSE s END AS pos, bad AS h, '' AS proof, n > 1 AS deep FROM placed
  UNION ALL
  SELECT c.rowid_, c.src, CASE WHEN c.deep AND any_value(x.n) <= 3 THEN -1 ELSE c.t END, CASE WHEN c.deep AND any_value(x.n) <= 3 THEN 0 ELSE c.lvl + 1 END,
    CASE WHEN c.deep AND any_value(x.n) <= 3 THEN c.src ELSE c.pos // 3 END,
    sha256(string_agg(CASE WHEN x.pos = c.pos THEN c.h ELSE x.h END, '' ORDER BY x.pos)),
    c.proof || coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (WHERE x.pos <> c.pos), ''), c.deep AND any_value(x.n) > 3
  FROM climb c JOIN nodes x ON x.s = c.t AND x.lvl = c.lvl AND x.pos // 3 = c.pos // 3 AND x.n > 1
  GROUP BY c.rowid_, c.src, c.t, c.lvl, c.pos, c.h, c.proof, c.deep),
ended AS (SELECT c.rowid_, c.h, c.proof FROM climb c WHERE c.t = -1 AND c.lvl = (SELECT max(lvl) FROM top))
SELECT p.doc_id, p.leaf, r.h AS subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = t.h AS verified
FROM placed p JOIN ended e ON e.rowid_ = p.rowid_ JOIN subroot r ON r.s = p.s CROSS JOIN (SELECT h FROM top WHERE n = 1) t"""


@query("op13_merkle_manifest", _ORACLE)
def op13_merkle_manifest(spark, d):
    """Leaf, subroot and root of every document, its proof, and the root folded from its tampered leaf."""
    docs = read(spark, d, "documents")
    m = manifest(docs, without_line_ends(F.col("doc_id"), F.col("text")))
    proof = F.sha2(_hex(F.col("siblings")), 256)
    return m.select("doc_id", _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"), proof.alias("proof_sha256"), _hex(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
