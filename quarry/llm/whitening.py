"""Embedding whitening by Jacobi-Davidson on distributed products.

The covariance matrix is never formed: a product with a block of vectors is one
Spark job, in which every task centres its rows, multiplies them by the block
and by their own transpose and gives one partial sum per dimension. The driver
holds vectors as long as one embedding, and a few dozen of them.

Jacobi-Davidson: Rayleigh-Ritz on the search space gives the Ritz pairs; for
each wanted pair not yet locked MINRES solves its projected correction equation
(I - QQ')(A - theta I)(I - QQ') t = -r, Q holding the locked vectors and the
current Ritz vectors; all pairs take their inner steps together, so a step is
one product with a block. Pairs are locked in order when their residual is down
to rounding; a few guard vectors beyond the wanted ones keep the search from
passing over an eigenvalue. The space is restarted from its Ritz vectors.

Entries become integers, so the sums per dimension and the deviations are exact;
rows are centred by the whole part of the mean first, its fraction second, which
keeps every digit of a double.

Vectors that are null or empty, or hold null or non-finite entries, are dropped.
Those of another length than the most frequent one (the longest of equally
frequent ones) have no place in the matrix and are dropped too. Null ids and
repeated rows keep a result each. Components end where the eigenvalue is lost in
rounding: equal vectors, or one vector, have none. Integers beyond 64 bits stop
at its ends. Deviations are decimals; a long is null where one does not fit.
Columns beside the two are not read, whatever their names. An empty table gives
an empty result.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import read, stored
from quarry.llm.registry import query

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
GUARD = 4  # vectors searched for beyond the wanted ones
SPACE = 4  # the search space holds so many blocks before it is restarted
INNER = 8  # MINRES steps for a correction
OUTER = 200
ROWS = 4096  # rows multiplied at once


# ---------------------------------------------------------------- rows


def integers(df: DataFrame, id_col: str, vec_col: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(id, x): whole entries floor(scale * c) + shift of every row that has a usable vector."""
    c = F.col(vec_col)
    sound = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    top = F.lit(2.0**62)
    whole = F.transform(c, lambda e: F.floor(F.greatest(F.least(e.cast("double") * scale, top), -top)).cast("bigint") + shift)
    return df.select(F.col(id_col).alias("id"), F.when(sound, whole).alias("x")).where(F.col("x").isNotNull())


def _matrix(column) -> np.ndarray:
    """A list<bigint> column as rows."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return arr.flatten().to_numpy(zero_copy_only=False).reshape(len(arr), -1)


def _exact(m: np.ndarray) -> np.ndarray:
    """``m`` as Python integers unless sums of its squares fit 64 bits."""
    most = max(abs(int(m.max())), abs(int(m.min()))) if m.size else 0
    return m if most * most * (m.shape[0] + m.shape[1] + 1) < 1 << 62 else m.astype(object)


def moments(rows: DataFrame) -> tuple[int, list[int], list[int]]:
    """Row count and, per dimension, exact sums of x and of its squares."""

    def run(batches):
        n, s, q = 0, None, None
        for b in batches:
            m = _exact(_matrix(b.column("x")))
            if not len(m):
                continue
            part_s, part_q = m.sum(0).astype(object), (m * m).sum(0).astype(object)
            n, s, q = n + len(m), part_s if s is None else s + part_s, part_q if q is None else q + part_q
        if n:
            dec = lambda v: pa.array([Decimal(int(x)) for x in v], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(s)), pa.int32()), pa.array([n] * len(s), pa.int64()), dec(s), dec(q)], ["dim", "n", "s", "q"])

    parts = rows.select("x").mapInArrow(run, "dim int, n bigint, s decimal(38,0), q decimal(38,0)")
    total = parts.groupBy("dim").agg(F.sum("n"), F.sum("s"), F.sum("q")).orderBy("dim").collect()
    return (int(total[0][1]) if total else 0), [int(r[2]) for r in total], [int(r[3]) for r in total]


class Centred:
    """Rows minus their mean: the whole part as integers, the fraction as doubles."""

    def __init__(self, n: int, sums: list[int]):
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([(s % n) / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest


def _pieces(batches, name: str = "x"):
    for b in batches:
        m = _matrix(b.column(name))
        for a in range(0, len(m), ROWS):
            yield m[a : a + ROWS]


def _summed(rows: DataFrame, of, width: int) -> np.ndarray:
    """Sum over all rows of the matrices ``of(x)``, by dimension: tasks give a row per
    matrix row, combined by Spark; the driver gets one matrix."""

    def run(batches):
        total = None
        for x in _pieces(batches):
            part = of(x)
            total = part if total is None else total + part
        if total is not None:
            cols = [pa.array(range(len(total)), pa.int32()), *(pa.array(np.ascontiguousarray(total[:, j])) for j in range(width))]
            yield pa.RecordBatch.from_arrays(cols, ["dim", *(f"c{j}" for j in range(width))])

    parts = rows.select("x").mapInArrow(run, "dim int, " + ", ".join(f"c{j} double" for j in range(width)))
    total = parts.groupBy("dim").agg(*[F.sum(f"c{j}") for j in range(width)]).collect()
    return np.array([list(r)[1:] for r in sorted(total, key=lambda r: r[0])])


def covariance_product(rows: DataFrame, n: int, centred: Centred):
    """v -> Vv for a block of column vectors, V being the covariance of the rows."""

    def product(block: np.ndarray) -> np.ndarray:
        def of(x):
            y = centred(x)
            return y.T @ (y @ block)

        return _summed(rows, of, block.shape[1]) / n

    return product


# ---------------------------------------------------------------- eigenvectors


def _orthonormal(new: np.ndarray, old: np.ndarray) -> np.ndarray:
    """The part of ``new`` beyond the orthonormal ``old``, orthonormal; columns that have none are left out."""
    out = old[:, :0]
    for t in new.T:
        size = np.linalg.norm(t)
        if not np.isfinite(size) or size == 0:
            continue
        t = t / size
        for _ in range(3):
            t = t - old @ (old.T @ t)
            t = t - out @ (out.T @ t)
        size = np.linalg.norm(t)
        if size > 1e-10:
            out = np.column_stack([out, t / size])
    return out


def _minres(apply, rhs: np.ndarray, steps: int) -> np.ndarray:
    """MINRES for several symmetric systems in step: ``apply`` maps a block whose column j belongs to system j."""
    b, zero = np.linalg.norm(rhs, axis=0), np.zeros(rhs.shape[1])
    v, v_old = rhs / np.where(b > 0, b, 1), np.zeros_like(rhs)
    w, w_old, x = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    beta, eta, c, c_old, s, s_old = zero.copy(), b.copy(), zero + 1, zero + 1, zero.copy(), zero.copy()
    live = b > 0
    for _ in range(steps):
        if not live.any():
            break
        p = apply(v)
        alpha = (v * p).sum(0)
        nxt = p - alpha * v - beta * v_old
        beta_new = np.linalg.norm(nxt, axis=0)
        rho0 = c * alpha - c_old * s * beta
        rho1 = np.hypot(rho0, beta_new)
        rho2, rho3 = s * alpha + c_old * c * beta, s_old * beta
        live &= rho1 > 1e-300
        safe = np.where(rho1 > 1e-300, rho1, 1)
        c_old, c, s_old, s = c, rho0 / safe, s, beta_new / safe
        w_old, w = w, (v - rho3 * w_old - rho2 * w) / safe
        x = np.where(live, x + c * eta * w, x)
        eta = -s * eta
        live &= beta_new > 1e-14 * np.abs(alpha)
        v_old, v, beta = v, nxt / np.where(beta_new > 0, beta_new, 1), beta_new
    return x


def jacobi_davidson(product, dim: int, wanted: int, seed: int = 7, guard: int = GUARD, inner: int = INNER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors, residuals relative to the largest value) of the ``wanted`` largest
    eigenpairs of the symmetric ``product``. Fails if a residual stays above rounding."""
    wanted = min(wanted, dim)
    block = min(dim, wanted + guard)
    space = _orthonormal(np.random.default_rng(seed).standard_normal((dim, block)), np.zeros((dim, 0)))
    image = product(space)
    tolerance = 4 * np.finfo(float).eps * dim
    locked = 0
    for _ in range(OUTER):
        h = space.T @ image
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, ritz_image = space @ turn, image @ turn
        scale = max(abs(values[0]), np.finfo(float).tiny)
        residual = ritz_image - ritz * values
        size = np.linalg.norm(residual, axis=0) / scale
        locked = 0  # pairs are locked in order: those before the first open one
        while locked < wanted and size[locked] <= tolerance:
            locked += 1
        if locked == wanted:
            return values[:wanted], ritz[:, :wanted], size[:wanted]
        if space.shape[1] > (SPACE - 1) * block and space.shape[1] < dim:  # restart from the Ritz vectors
            space, image = ritz[:, :block], ritz_image[:, :block]
            ritz, ritz_image, values, residual = ritz[:, :block], ritz_image[:, :block], values[:block], residual[:, :block]
        if space.shape[1] == dim:  # the whole space, read again to shed the rounding of restarts
            space = _orthonormal(ritz, np.zeros((dim, 0)))
            image = product(space)
            continue
        open_ = np.arange(locked, block)
        shift, keep = values[open_], ritz[:, :block]
        off = lambda m: m - keep @ (keep.T @ m)
        step = _minres(lambda m: off(product(off(m)) - off(m) * shift), -off(residual[:, open_]), inner)
        new = _orthonormal(off(step), space)
        if not new.shape[1]:
            new = _orthonormal(np.random.default_rng(seed + 1).standard_normal((dim, min(block, dim - space.shape[1]))), space)
        space, image = np.column_stack([space, new]), np.column_stack([image, product(new)])
    raise RuntimeError(f"{locked} of {wanted} eigenpairs reached double precision; residuals {size[:wanted]}")


# ---------------------------------------------------------------- operator


def whiten(df: DataFrame, id_col: str, vec_col: str, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row per usable vector and component."""
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    shape = f"id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = stored(integers(df, id_col, vec_col, scale, shift), "whiten-rows")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], shape)
    dim = lengths[0]["d"]
    rows = rows.where(F.size("x") == dim)
    held = rows.select("x").persist(StorageLevel.MEMORY_AND_DISK)  # lost blocks are read again from the stored rows
    try:
        n, sums, squares = moments(held)
        centred = Centred(n, sums)
        trace = sum(n * q - s * s for s, q in zip(sums, squares)) / (n * n)
        values, vectors = np.zeros(0), np.zeros((dim, 0))
        if trace > 0:
            values, vectors, _ = jacobi_davidson(covariance_product(held, n, centred), dim, components)
        sound = values > trace * dim * 4 * np.finfo(float).eps
        values, vectors = values[sound], vectors[:, sound]
        k = len(values)
        if not k:
            return spark.createDataFrame([], shape)
        to_white = vectors / np.sqrt(values)

        def spread(x):
            y = centred(x) @ to_white
            return np.column_stack([y.T @ y, y.sum(0)])

        total = _summed(held, spread, k + 1)
    finally:
        held.unpersist()
    mean = total[:, k] / n
    error = float(np.abs(total[:, :k] / n - np.outer(mean, mean) - np.eye(k)).max())
    share = (values / trace).tolist()

    def run(batches):
        exact = np.array(sums, object)
        for b in batches:
            ids, x = b.column("id"), _matrix(b.column("x"))
            for a in range(0, len(x), ROWS):
                part = x[a : a + ROWS]
                near = part - centred.whole  # n * x - sum, from the whole part of the mean
                left = exact - n * centred.whole.astype(object)
                most = n * max(abs(int(near.max())), abs(int(near.min())), 1) + n
                far = (n * near - left.astype(np.int64)) if most * most * dim < 1 << 62 else n * near.astype(object) - left
                deviation = (far * far).sum(1)
                white = centred(part) @ to_white
                cols = [
                    ids.slice(a, len(part)).take(pa.array(np.repeat(np.arange(len(part)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                    pa.array(np.full(len(part) * k, n, np.int64)),
                    pa.array([Decimal(int(v)) for v in deviation for _ in range(k)], pa.decimal128(38, 0)),
                    pa.array(white.reshape(-1)),
                    pa.array(np.tile(share, len(part))),
                    pa.array(np.full(len(part) * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, shape)


@query("op11_whitening")
def op11_whitening(spark, d):
    """Every embedding on the eight leading whitened components."""
    w = whiten(read(spark, d, "embeddings"), "vec_id", "embedding")
    return w.withColumn("deviation", F.expr("try_cast(deviation AS bigint)")).withColumnRenamed("id", "vec_id")
