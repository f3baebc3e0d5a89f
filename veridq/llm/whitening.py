"""Embedding whitening from bit-sliced scatter matrices.

An entry c of a vector becomes the integer x = floor(``SCALE`` * c) + ``SHIFT``.

1. Every task packs its vectors, up to ``WORD_ROWS`` at a time: the entries of a dimension,
   less their minimum there, are cut into bit planes, and a plane's bits of 64 rows fill a
   word.  The popcount of plane p of dimension i AND plane q of dimension j, weighted with
   2^(p+q), summed over p and q, is the exact sum of products; adding the minima back is
   integer arithmetic too.  A task sends one row per pair of dimensions.
2. Spark adds counts, sums and cross-products as decimals.  What reaches the driver is one
   matrix per vector length, whatever the number of rows.
3. The covariance is centred in integers, (n*C - S*S') / n^2, before it becomes double.
   ``eigh`` gives its components, by falling eigenvalue, each with its largest entry
   positive.
4. Every row is projected: (n*x - S) / n on a component, over the root of its eigenvalue.
   The covariance of what was written is measured, centred before multiplying.

Defined cases: a row goes if its vector is null, holds a null or non-finite entry, or an
entry of ``LIMIT`` or more in size (x is then no safe integer).  Vectors of different
lengths belong to different spaces: each length is fitted and whitened by itself, with its
own n.  Empty vectors have no components and give no rows.  A component without variance
(eigenvalue below ``FLAT`` of the largest; all of them if n is 1) has whitened 0 and is left
out of ``identity_error``.  Null and repeated ids, equal vectors and further columns are
fine: each row counts and each row comes back; an empty table gives no rows.  ``deviation``
is null if it does not fit 64 bits; ``deviation_exact`` holds it as a decimal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veridq.llm.common import materialise, ship

SCALE, SHIFT = 1024, 100_000
LIMIT = 2.0**40
WORD_ROWS = 8192  # rows packed at once
HELD_WORDS = 1 << 21  # words that one AND makes
FLAT = 1e-12
COMPONENTS = 8


def integers(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row positions, int64 matrix) for each vector length of ``batch``, at most
    ``WORD_ROWS`` rows at a time.  The batch's last column holds the vectors."""
    col = batch.column(batch.num_columns - 1)
    if not len(col):
        return
    flat = np.asarray(col.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False), np.float64)
    size = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(size) - size
    with np.errstate(invalid="ignore"):
        bad = np.r_[0, np.cumsum(~(np.abs(flat) < LIMIT))]
    good = (size > 0) & (bad[start + size] == bad[start])
    for d in np.unique(size[good]):
        at = np.flatnonzero(good & (size == d))
        step = max(1, min(WORD_ROWS, (1 << 24) // int(d)))
        for lo in range(0, len(at), step):
            rows = at[lo : lo + step]
            c = flat[start[rows][:, None] + np.arange(d)]
            yield rows, np.floor(SCALE * c).astype(np.int64) + SHIFT


def planes(y: np.ndarray) -> np.ndarray:
    """Bit planes of a matrix of non-negative integers: plane, dimension, word of 64 rows."""
    n, d = y.shape
    bits = max(1, int(y.max()).bit_length())
    padded = np.zeros((-(-n // 64) * 64, d), np.uint64)
    padded[:n] = y
    out = np.empty((bits, d, len(padded) // 64), np.uint64)
    for p in range(bits):
        plane = np.packbits(((padded >> np.uint64(p)) & np.uint64(1)).astype(np.uint8).T, axis=1)
        out[p] = np.ascontiguousarray(plane).view(np.uint64)
    return out


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums (d) and cross-products (d, d) of the rows of ``x``, as Python integers."""
    n, d = x.shape
    low = x.min(axis=0)
    sliced = planes(x - low)
    bits, _, words = sliced.shape
    wide = 2 * bits + n.bit_length() > 62
    kind = object if wide else np.int64
    sums = np.zeros(d, object)
    cross = np.zeros((d, d), kind)
    step = max(1, HELD_WORDS // (d * words))
    for p in range(bits):
        sums += np.bitwise_count(sliced[p]).sum(axis=1).astype(object) * (1 << p)
        for q in range(p, bits):
            met = np.empty((d, d), np.int64)
            for lo in range(0, d, step):
                met[lo : lo + step] = np.bitwise_count(sliced[p][lo : lo + step, None] & sliced[q][None]).sum(axis=2, dtype=np.int64)
            both = met if p == q else met + met.T  # the pairs (p, q) and (q, p)
            cross += both.astype(kind) * (1 << (p + q))
    low = low.astype(object)
    cross = cross.astype(object) + np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low)
    return sums + n * low, cross


def _moments(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per vector length and pair i <= j; j = -1 has the sum of i, i = -1 the count."""
    held: dict[int, list] = {}
    for batch in batches:
        for rows, x in integers(batch):
            s, c = scatter(x)
            old = held.get(x.shape[1])
            held[x.shape[1]] = [len(rows), s, c] if old is None else [old[0] + len(rows), old[1] + s, old[2] + c]
    for d, (n, s, c) in held.items():
        out = lambda i, j, v: pa.RecordBatch.from_arrays([pa.array([d] * len(v), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(a) for a in v], pa.string())], schema=schema)  # noqa: B023, E731
        yield out([-1, *range(d)], [-1] * (d + 1), [n, *s])
        for i in range(d):
            yield out([i] * (d - i), list(range(i, d)), c[i, i:])


class Space:
    """Fitted whitening of the vectors of one length."""

    def __init__(self, n: int, sums: list[int], cross: list[list[int]], k: int):
        d = len(sums)
        self.n, self.sums = n, sums
        v = np.empty((d, d))
        for i in range(d):
            for j in range(i, d):  # integer division rounds once
                v[i, j] = v[j, i] = (n * cross[i][j] - sums[i] * sums[j]) / (n * n)
        e, u = np.linalg.eigh(v)
        order = np.argsort(-e, kind="stable")[:k]
        u = u[:, order]
        u *= np.where(np.take_along_axis(u, np.abs(u).argmax(axis=0)[None], 0)[0] < 0, -1.0, 1.0)
        trace = float(sum(n * cross[i][i] - sums[i] * sums[i] for i in range(d)) / (n * n))
        self.values, self.vectors = e[order], u
        self.flat = self.values <= FLAT * max(float(e[-1]), 0.0) if trace > 0 else np.ones(len(order), bool)
        self.explained = np.where(trace > 0, self.values / (trace or 1.0), 0.0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exactly."""
        bound = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        kind = np.int64 if bound < 1 << 62 else object
        return self.n * x.astype(kind) - np.array(self.sums, kind)

    def deviation(self, t: np.ndarray) -> list[int]:
        most = int(np.abs(t).max(initial=0))
        if most * most * t.shape[1] >= 1 << 62:
            t = t.astype(object)
        return [int(a) for a in (t * t).sum(axis=1)]

    def whiten(self, t: np.ndarray) -> np.ndarray:
        w = (t / self.n).astype(np.float64) @ self.vectors
        return np.where(self.flat, 0.0, w / np.sqrt(np.where(self.flat, 1.0, self.values)))


def fit(vectors: DataFrame, column: str = "embedding", k: int = COMPONENTS) -> dict[int, Space]:
    """Vector length -> its fitted space."""
    ship(vectors.sparkSession)
    schema = pa.schema([("d", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("v", pa.string())])
    sent = vectors.select(column).mapInArrow(lambda b: _moments(b, schema), "d int, i int, j int, v string")
    total = sent.groupBy("d", "i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    got: dict[int, dict] = {}
    for r in total.toLocalIterator():
        got.setdefault(r.d, {})[r.i, r.j] = int(r.v)
    return {d: Space(m[-1, -1], [m[i, -1] for i in range(d)], [[m.get((i, j), 0) for j in range(d)] for i in range(d)], k) for d, m in got.items()}


ROWS = "dim int, n long, deviation long, deviation_exact decimal(38,0), whitened array<double>"


def transform(vectors: DataFrame, spaces: dict[int, Space], column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key``, dim, n, deviation, deviation_exact and the whitened vector of every row that
    is not dropped."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(vectors.sparkSession)
    kind = StructType.fromDDL(f"vec_id {vectors.schema[key].dataType.simpleString()}, {ROWS}")
    schema = to_arrow_schema(kind)
    shared = vectors.sparkSession.sparkContext.broadcast(spaces)  # one d x k matrix and d sums per length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in integers(batch):
                space = shared.value[x.shape[1]]
                t = space.centred(x)
                dev, m = space.deviation(t), len(rows)
                import decimal

                fits = [a if a < 1 << 63 else None for a in dev]
                exact = [decimal.Decimal(a) if a < 10**38 else None for a in dev]
                cols = [batch.column(0).take(pa.array(rows)), *(pa.array([v] * m) for v in (x.shape[1], space.n)), pa.array(fits, pa.int64()), pa.array(exact, pa.decimal128(38, 0)), pa.array(list(space.whiten(t)))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return vectors.select(F.col(key).alias("vec_id"), F.col(column).alias("embedding")).mapInArrow(run, kind)


def identity_errors(whitened: DataFrame, spaces: dict[int, Space]) -> dict[int, float]:
    """Vector length -> largest absolute entry of the measured covariance of ``whitened``
    less the identity, over the components with variance."""
    out = {}
    means = {r.dim: r.m for r in whitened.groupBy("dim").agg(F.array(*[F.avg(F.get("whitened", F.lit(i))) for i in range(COMPONENTS)]).alias("m")).collect()}
    pairs = [(i, j) for i in range(COMPONENTS) for j in range(i, COMPONENTS)]
    table = [F.when(F.col("dim") == d, F.array(*[F.lit(v).cast("double") for v in m])) for d, m in means.items()]
    if not table:
        return out
    centred = whitened.withColumn("c", F.zip_with("whitened", F.coalesce(*table), lambda a, b: a - b))
    at = lambda i: F.get("c", F.lit(i))
    for r in centred.groupBy("dim").agg(F.array(*[F.avg(at(i) * at(j)) for i, j in pairs]).alias("v")).collect():
        live = [not f for f in spaces[r.dim].flat]
        size = len(live)
        errors = [abs(v - (i == j)) for (i, j), v in zip(pairs, r.v, strict=True) if i < size and j < size and live[i] and live[j]]
        out[r.dim] = max(errors, default=0.0)
    return out


def whiten(vectors: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained,
    identity_error, dim, deviation_exact.  Up to ``COMPONENTS`` components."""
    spaces = fit(vectors, column)
    rows = materialise(transform(vectors, spaces, column, key), "whitened")
    errors = identity_errors(rows, spaces)
    pick = lambda of, kind: F.coalesce(F.lit(None).cast(kind), *[F.when(F.col("dim") == d, of(d)) for d in spaces])
    shares = pick(lambda d: F.array(*[F.lit(float(v)) for v in spaces[d].explained]), "array<double>")
    error = pick(lambda d: F.lit(errors.get(d, 0.0)).cast("double"), "double")
    each = rows.select("*", F.posexplode("whitened").alias("at", "w"), shares.alias("shares"), error.alias("identity_error"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("w").alias("whitened"),
        F.get("shares", F.col("at")).alias("explained"),
        "identity_error",
        "dim",
        "deviation_exact",
    )
