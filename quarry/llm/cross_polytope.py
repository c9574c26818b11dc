"""Near-duplicate embeddings: cross-polytope hashing, multiprobe buckets, verified pairs.

Equal vectors are one node with a weight. A hash rotates a vector by three
rounds of random signs and the fast Hadamard transform and takes the largest
coordinate with its sign; a bucket of a table joins several hashes, the last of
fewer coordinates, so that the mean bucket keeps its size however many vectors
there are. A vector goes to the best ``PROBES`` buckets of each table. The
number of tables is what ``RECALL`` asks for: the hit rate of one table is
measured on random pairs at exactly the threshold's angle.

Buckets are compared by matrix products; one of more than ``PART`` vectors is
cut into parts, and pairs of parts are tasks of their own. Every product of two
unit vectors at or over the threshold is a link; a bucket gives a spanning
forest of its links, not all of them, and connected components join those on
Spark. Links of a vector are then counted inside its component, again in parts:
each pair of the component's vectors is compared once, whichever tables found
it, and links that no table found are counted too. The rows moved grow with
the vectors; the products inside one dense group grow with the square of its
distinct vectors, which no bucket can save where all of them link.

Null, empty and zero vectors and those with null or non-finite components link
with nothing and are components of their own. Vectors of different length do not
link. A row's id may be null or repeated: each row counts as a vector, a
component has its smallest non-null id, and a row without one names itself.
``kept`` is then true of each row that carries the component's id. Columns
beside the two are not read, whatever their names. An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import connected_components, read, salt_of, stored
from quarry.llm.registry import query

THRESHOLD = 0.9
RECALL = 0.99  # of pairs at the threshold itself; closer ones are found more often
PROBES = 3
BUCKET = 400  # vectors in a mean bucket
PART = 2048  # vectors compared at once
ROUNDS = 3
MOST_TABLES = 400
SEED = 20


# ---------------------------------------------------------------- hashing


def _hadamard(m: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of every row; the width is a power of two."""
    n, h = m.shape[1], 1
    m = m.copy()
    while h < n:
        m = m.reshape(len(m), n // (2 * h), 2, h)
        m = np.stack((m[:, :, 0] + m[:, :, 1], m[:, :, 0] - m[:, :, 1]), axis=2).reshape(len(m), n)
        h *= 2
    return m / math.sqrt(n)


class Hashes:
    """The tables for vectors of one length: ``widths`` are the coordinates each hash of a table looks at."""

    def __init__(self, dim: int, widths: list[int], tables: int, seed: int = SEED):
        self.size = 1 << max(0, dim - 1).bit_length()
        self.dim, self.widths, self.tables = dim, widths, tables
        rng = np.random.default_rng([seed, dim])
        self.signs = rng.choice([-1.0, 1.0], (tables, len(widths), ROUNDS, self.size))

    def keys(self, unit: np.ndarray, table: int, probes: int = PROBES) -> np.ndarray:
        """(row, probe) buckets, the best first: each hash offers its best choices, and joint choices go by what they give up."""
        padded = np.zeros((len(unit), self.size))
        padded[:, : self.dim] = unit
        key, cost = np.zeros((len(unit), 1), np.int64), np.zeros((len(unit), 1))
        for j, width in enumerate(self.widths):
            y = padded
            for r in range(ROUNDS):
                y = _hadamard(y * self.signs[table, j, r])
            y = np.concatenate((y[:, :width], -y[:, :width]), axis=1)
            take = min(probes, y.shape[1])
            best = np.argpartition(-y, take - 1, axis=1)[:, :take]
            value = np.take_along_axis(y, best, 1)
            loss = (value.max(1, keepdims=True) - value) ** 2
            # the best joint choices so far with each choice here; a worse beginning cannot end among the best
            key = (key[:, :, None] * (2 * width) + best[:, None, :]).reshape(len(unit), -1)
            cost = (cost[:, :, None] + loss[:, None, :]).reshape(len(unit), -1)
            first = np.argsort(cost, axis=1, kind="stable")[:, :probes]
            key, cost = np.take_along_axis(key, first, 1), np.take_along_axis(cost, first, 1)
        return key


def widths_for(dim: int, vectors: int, probes: int = PROBES, bucket: int = BUCKET) -> list[int]:
    """So many hashes, the last of so many coordinates, that a mean bucket holds about ``bucket`` vectors."""
    size = 1 << max(0, dim - 1).bit_length()
    wanted, out = max(2.0, vectors * probes / bucket), []
    while wanted > 2 * size and size > 1:
        out.append(size)
        wanted /= 2 * size
    return [*out, min(size, max(1, math.ceil(wanted / 2)))]


def tables_for(dim: int, widths: list[int], threshold: float = THRESHOLD, recall: float = RECALL, pairs: int = 2000, trials: int = 6) -> int:
    """Tables that find ``recall`` of the pairs at the threshold, from the hit rate on random ones."""
    rng = np.random.default_rng([SEED, dim, len(widths)])
    a = rng.standard_normal((pairs, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((pairs, dim))
    b -= (a * b).sum(1, keepdims=True) * a
    length = np.linalg.norm(b, axis=1, keepdims=True)
    b = threshold * a + math.sqrt(1 - threshold**2) * np.divide(b, length, out=np.zeros_like(b), where=length > 1e-9)
    h = Hashes(dim, widths, trials)
    hits = [(h.keys(a, t)[:, :, None] == h.keys(b, t)[:, None, :]).any((1, 2)).mean() for t in range(trials)]
    rate = min(max(float(np.mean(hits)), 0.01), 0.9999)
    return min(MOST_TABLES, max(2, math.ceil(math.log(1 - recall) / math.log(1 - rate))))


# ---------------------------------------------------------------- rows and nodes


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows over their lengths, whatever their scale."""
    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, node, vec, dim): a digest of each vector that can link, null for others."""
    c, kind = F.col(vec_col), df.schema[id_col].dataType.simpleString()
    sound = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(c, lambda e: e != 0)

    def run(batches):
        for b in batches:
            lists = b.column("vec")
            whole = lists.flatten()
            width = whole.type.bit_width // 8 if len(whole) else 8
            flat = (whole.to_numpy(zero_copy_only=False) + 0.0).tobytes()  # one zero, not two
            ends = np.cumsum(np.nan_to_num(np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), float))).astype(int) * width
            starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            vecs = [flat[x:y] if y > x else None for x, y in zip(starts.tolist(), ends.tolist())]
            nodes = [None if v is None else hashlib.md5(v, usedforsecurity=False).digest() for v in vecs]
            dims = [0 if v is None else len(v) // width for v in vecs]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(nodes, pa.binary()), pa.array(vecs, pa.binary()), pa.array(dims, pa.int32())], ["id", "node", "vec", "dim"])

    return df.select(F.col(id_col).alias("id"), F.when(sound, c).alias("vec")).mapInArrow(run, f"id {kind}, node binary, vec binary, dim int")


def _units(column, dim: int, width: int) -> np.ndarray:
    raw = b"".join(column)
    return unit_rows(np.frombuffer(raw, np.float32 if width == 4 else np.float64).reshape(-1, dim).astype(float))


def _in_groups(batches, keys: list[str], at_once: int):
    """Batches sorted by ``keys`` as whole groups: (key values, rows of each other column); groups are bounded by the caller."""
    held, names = None, None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        names = names or [n for n in t.column_names if n not in keys]
        if held.num_rows >= at_once or held.nbytes >= 1 << 25:
            cuts = _cuts(held, keys)
            if len(cuts) > 2:
                yield from _each(held.slice(0, cuts[-2]), keys, names, cuts[:-1])
                held = held.slice(cuts[-2])
    if held is not None and held.num_rows:
        yield from _each(held, keys, names, _cuts(held, keys))


def _cuts(t, keys) -> list[int]:
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for k in keys:
        c = t.column(k).combine_chunks()
        c = c.to_numpy(zero_copy_only=False)
        new[1:] |= c[1:] != c[:-1]
    return [*np.flatnonzero(new).tolist(), t.num_rows]


def _each(t, keys, names, cuts):
    for a, b in zip(cuts, cuts[1:]):
        part = t.slice(a, b - a)
        yield {k: part.column(k)[0].as_py() for k in keys}, {n: part.column(n).to_pylist() for n in names}


def _parted(rows: DataFrame, keys: list[str], part: int, broadcast_groups: int = 200_000) -> DataFrame:
    """``rows`` with (i, j, side): a group of more than ``part`` rows is cut by hash of the node, and
    each row goes to every pair (i, j) of parts with its own; a smaller group is the pair (0, 0)."""
    sizes = stored(rows.groupBy(*keys).agg(F.count("*").alias("n_")).where(F.col("n_") > part), "cp-large")
    small = F.broadcast(sizes) if sizes.count() <= broadcast_groups else sizes
    rows = rows.join(small, keys, "left").withColumn("parts_", F.coalesce(F.ceil(F.col("n_") / (part * 0.8)), F.lit(1)).cast("int"))
    rows = rows.withColumn("own_", F.pmod(F.xxhash64("node"), F.col("parts_")).cast("int"))
    rows = rows.withColumn("other_", F.explode(F.sequence(F.lit(0), F.col("parts_") - 1)))
    return rows.select(*[c for c in rows.columns if not c.endswith("_")], F.least("own_", "other_").alias("i"), F.greatest("own_", "other_").alias("j"), (F.col("own_") <= F.col("other_")).alias("side"))


# ---------------------------------------------------------------- links and counts


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of a symmetric boolean matrix: each node found with the one that found it."""
    left, out = np.ones(len(near), bool), []
    while left.any():
        start = int(np.argmax(left))
        left[start] = False
        reached = [start]
        while reached:
            x = reached.pop()
            new = np.flatnonzero(near[x] & left)
            left[new] = False
            out += [(x, int(y)) for y in new]
            reached += new.tolist()
    return out


def links(nodes: DataFrame, threshold: float, dims: dict[int, int], width: int, recall: float = RECALL, probes: int = PROBES, bucket: int = BUCKET, part: int = PART) -> DataFrame:
    """(a, b) links of distinct nodes: a spanning forest of what each bucket holds."""
    hashes = {}
    for dim, n in dims.items():
        widths = widths_for(dim, n, probes, bucket)
        hashes[dim] = Hashes(dim, widths, tables_for(dim, widths, threshold, recall))

    def deal(batches):
        for b in batches:
            dim = b.column("dim").to_numpy()
            for each in np.unique(dim):
                rows = b.filter(pa.array(dim == each))
                h = hashes[int(each)]
                for a in range(0, rows.num_rows, 4096):
                    some = rows.slice(a, 4096)
                    unit = _units(some.column("vec").to_pylist(), h.dim, width)
                    for t in range(h.tables):
                        keys = h.keys(unit, t, probes)
                        for p in range(keys.shape[1]):
                            yield pa.RecordBatch.from_arrays([some.column("dim"), pa.array(np.full(len(keys), t, np.int32)), pa.array(np.ascontiguousarray(keys[:, p])), some.column("node"), some.column("vec")], ["dim", "t", "key", "node", "vec"])

    group = ["dim", "t", "key"]
    dealt = nodes.select("dim", "node", "vec").mapInArrow(deal, "dim int, t int, key bigint, node binary, vec binary")
    # buckets of one vector have no pair; parts go to tasks of their own
    return _parted(dealt, group, part).repartition(*group, "i", "j").sortWithinPartitions(*group, "i", "j").mapInArrow(_linked(threshold, width, group), "a binary, b binary").distinct()


def _linked(threshold: float, width: int, group: list[str]):
    def run(batches):
        a, b = [], []
        for key, rows in _in_groups(batches, [*group, "i", "j"], 16 * PART):
            nodes = rows["node"]
            if len(nodes) < 2:
                continue
            unit = _units(rows["vec"], key["dim"], width)
            for x, y in _forest(unit @ unit.T >= threshold):
                a.append(nodes[x])
                b.append(nodes[y])
            if len(a) > 1 << 16:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return run


def link_counts(members: DataFrame, threshold: float, width: int, part: int = PART) -> DataFrame:
    """(node, links): weight of the other nodes of its component (root) at or over the threshold."""

    def run(batches):
        for key, rows in _in_groups(batches, ["root", "i", "j"], 16 * PART):
            unit, weight, side = _units(rows["vec"], rows["dim"][0], width), np.array(rows["w"], np.int64), np.array(rows["side"])
            near = unit @ unit.T >= threshold
            np.fill_diagonal(near, False)
            if key["i"] != key["j"]:  # two parts: pairs across them only
                near &= side[:, None] != side[None, :]
            yield pa.RecordBatch.from_arrays([pa.array(rows["node"], pa.binary()), pa.array(near @ weight)], ["node", "links"])

    group = ["root", "i", "j"]
    dealt = _parted(members.select("root", "node", "vec", "dim", "w"), ["root"], part)
    return dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, "node binary, links bigint").groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(df: DataFrame, id_col: str, vec_col: str, threshold: float = THRESHOLD, recall: float = RECALL, probes: int = PROBES, bucket: int = BUCKET, part: int = PART) -> DataFrame:
    """(id, n_links, component_id, kept), a row per input row."""
    element = df.schema[vec_col].dataType.elementType.simpleString()
    width = 4 if element == "float" else 8
    if element not in ("float", "double"):
        df = df.select(F.col(id_col), F.col(vec_col).cast("array<double>"))
    each = stored(vectors(df, id_col, vec_col), "cp-rows")
    salts = 1 + each.count() // 100_000
    each = each.withColumn("salt", salt_of("id", buckets=salts))
    sound = each.where("node is not null")
    parts = stored(sound.groupBy("node", "salt").agg(F.count("*").alias("w"), F.min("id").alias("first_id"), F.first("vec").alias("vec"), F.first("dim").alias("dim")), "cp-parts")
    nodes = stored(parts.groupBy("node").agg(F.sum("w").alias("w"), F.min("first_id").alias("first_id"), F.first("vec").alias("vec"), F.first("dim").alias("dim")), "cp-nodes")
    dims = {r["dim"]: r["n"] for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    found = connected_components(links(nodes, threshold, dims, width, recall, probes, bucket, part))
    members = stored(found.join(nodes, "node"), "cp-members")
    counts = link_counts(members, threshold, width, part)
    ids = members.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n"))
    ids = stored(ids, "cp-names")
    # a component of many vectors is named by a broadcast row, the others by a join
    large = ids.where(F.col("n") > part).select("root", "component_id")
    hot = F.broadcast(large) if large.count() <= 200_000 else large
    slim = members.select("root", "node")
    named = slim.join(hot, "root").unionByName(slim.join(hot.select("root"), "root", "left_anti").join(ids.where(F.col("n") <= part).select("root", "component_id"), "root"))
    known = nodes.select("node", "w", "first_id").join(named.select("node", "component_id"), "node", "left").join(counts, "node", "left")
    # repeats are links too: the other rows of the same vector
    known = known.select("node", F.coalesce("component_id", "first_id").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"))
    # results reach the rows per (node, salt): a vector that a third of all rows share is many join keys
    spread = parts.select("node", "salt").join(known, "node")
    alone = each.where("node is null").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    out = sound.select("id", "node", "salt").join(spread, ["node", "salt"]).select("id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


@query("op12_cross_polytope")
def op12_cross_polytope(spark, d):
    """Links and component of every embedding at a cosine of 0.9 or more."""
    return near_duplicates(read(spark, d, "embeddings"), "vec_id", "embedding").withColumnRenamed("id", "vec_id")
