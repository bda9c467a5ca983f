"""Whitening of embeddings by a block Jacobi-Davidson eigensolver.

The covariance is never formed. All the solver asks for is its product with
a few vectors at a time, and every product is one distributed pass: each
task centres its rows, multiplies, and returns one small matrix; the task
matrices are added in two steps. Vectors as long as an embedding, at most
``BASIS`` of them per wanted component, live on the driver; their size
depends on the dimension, not on the rows.

Outer loop: Rayleigh-Ritz in the search space; Ritz pairs whose residual has
reached double precision are locked, in order; for the others the projected
correction equations are solved by MINRES and the solutions extend the
space. The inner solves of all pairs run in step, so one pass serves them
all. The loop ends when the residuals of all wanted pairs, measured by a
product of their own, are at double precision.

Entries become integers, so sums and deviations are exact, and a row is
centred as (n * x - S) / n from exact integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, materialise, slices, table

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
BASIS = 10          # search space: at most so many vectors per component
INNER = 8           # MINRES steps of a correction equation, at most
ROUNDS = 200
PRECISION = 64 * np.finfo(float).eps   # residual relative to the largest eigenvalue
FLOOR = 1e-12       # the same, for passes whose rounding allows no better
SEED = 20240601
MERGERS = 8         # tasks that add up the matrices of all others
LONG_MAX = (1 << 63) - 1


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, x (integers) of the rows whose vector is whole: not null, not
    empty, without null or non-finite entries, and as long as most are (of
    equally frequent lengths the longest)."""
    wide = F.col("embedding").cast("array<double>")
    x = F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))).cast("long") + F.lit(OFFSET))
    whole = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), wide.alias("v"))
            .filter(F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(whole, F.lit(False)))
            .select("vec_id", x.alias("x")))
    rows = materialise(rows, "whitening")
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.filter(F.size("x") == sizes[0]["d"]) if sizes else rows


def matrix(column: pa.Array) -> np.ndarray:
    """Rows x dimensions of a list column without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: long integers while they fit, Python's beyond."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n
    if max(most, *map(abs, sums)) < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def squares(d: np.ndarray) -> list[int]:
    """Sum of squares of every row, exact."""
    if d.dtype != object:
        if len(d) and float(np.abs(d).max()) ** 2 * d.shape[1] < 2.0 ** 62:
            return (d * d).sum(axis=1).tolist()
        d = d.astype(object)
    return (d * d).sum(axis=1).tolist()


def column_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact sum of every dimension. A task returns one row per
    dimension; the driver gets as many."""
    kind = pa.schema([("pos", pa.int32()), ("rows", pa.int64()), ("total", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, None
        for part in batches:
            if part.num_rows:
                x = matrix(part.column(0))
                safe = max(abs(int(x.max())), abs(int(x.min()))) < 1 << 40
                own = (x if safe else x.astype(object)).sum(axis=0).astype(object)
                rows, total = rows + len(x), own if total is None else total + own
        if total is not None:
            yield batch(kind, np.arange(len(total)), [rows] * len(total), [Decimal(int(t)) for t in total])

    found = (vectors.select("x").mapInArrow(run, "pos int, rows long, total decimal(38,0)")
             .groupBy("pos").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total")).orderBy("pos").collect())
    return (int(found[0]["rows"]) if found else 0), [int(r["total"]) for r in found]


def add_up(vectors: DataFrame, n: int, sums: list[int], work: Callable[[np.ndarray], np.ndarray],
           shape: tuple[int, ...]) -> np.ndarray:
    """Sum of ``work(centred rows)`` over all rows: one matrix per task,
    added by ``MERGERS`` tasks, then on the driver."""
    kind = pa.schema([("m", pa.binary())])

    def total(parts: Iterable[np.ndarray]) -> np.ndarray:
        out, lost = np.zeros(shape), np.zeros(shape)
        for m in parts:  # compensated: the error does not grow with the rows
            m = m - lost
            new = out + m
            lost, out = (new - out) - m, new
        return out

    def stored(rows: Iterable[bytes]) -> Iterator[np.ndarray]:
        return (np.frombuffer(m).reshape(shape) for m in rows)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centred = (deviations(matrix(part.column(0)), n, sums).astype(float) / n
                   for part in slices(batches, 4096) if part.num_rows)
        yield batch(kind, [total(map(work, centred)).tobytes()])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield batch(kind, [total(stored(m for part in batches for m in part.column(0).to_pylist())).tobytes()])

    rows = vectors.select("x").mapInArrow(tasks, "m binary").repartition(MERGERS).mapInArrow(merge, "m binary")
    return total(stored(r["m"] for r in rows.collect()))


def covariance_product(vectors: DataFrame, n: int, sums: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """Z -> V Z for the covariance V: one pass over the vectors."""
    def product(z: np.ndarray) -> np.ndarray:
        return add_up(vectors, n, sums, lambda c: c.T @ (c @ z), z.shape) / n
    return product


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Approximate solutions of one symmetric system per column, all in
    step; ``apply`` multiplies column j by the matrix of system j. Ends
    after ``steps`` or when every residual is down by ``tolerance``."""
    tiny = np.finfo(float).tiny
    x, w, w_old, v_old = (np.zeros_like(rhs) for _ in range(4))
    first = np.linalg.norm(rhs, axis=0)
    live = first > tiny
    v = np.where(live, rhs / np.where(live, first, 1.0), 0.0)
    link, eta = np.zeros_like(first), first.copy()   # off-diagonal entry, signed residual norm
    c, c_old, s, s_old = np.ones_like(first), np.ones_like(first), np.zeros_like(first), np.zeros_like(first)
    for _ in range(steps):
        if not live.any():
            break
        # Lanczos: the next column of the tridiagonal matrix.
        y = apply(v) - link * v_old
        alpha = (v * y).sum(axis=0)
        y = y - alpha * v
        below = np.linalg.norm(y, axis=0)
        # The two rotations before it, then the one that clears its lowest entry.
        far, above = s_old * link, s * alpha + c_old * c * link
        delta = c * alpha - c_old * s * link
        gamma = np.hypot(delta, below)
        live &= gamma > tiny
        safe = np.where(live, gamma, 1.0)
        c_old, s_old = c, s
        c, s = delta / safe, below / safe
        w, w_old = (v - far * w_old - above * w) / safe, w
        x = x + np.where(live, c * eta, 0.0) * w
        eta = np.where(live, -s * eta, eta)
        live &= (np.abs(eta) > tolerance * first) & (below > tiny)
        v, v_old = np.where(live, y / np.where(live, below, 1.0), 0.0), v
        link = below
    return x


def orthonormal(new: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the orthonormal columns
    of ``against``; columns that add nothing are left out."""
    out = np.empty((len(new), 0))
    for column in new.T:
        size = np.linalg.norm(column)
        if not size or not np.isfinite(size):
            continue
        q = column / size
        for _ in range(3):
            q = q - against @ (against.T @ q) - out @ (out.T @ q)
        left = np.linalg.norm(q)
        if left > 1e-10:
            q = q / left
            q = q - against @ (against.T @ q) - out @ (out.T @ q)
            out = np.column_stack([out, q / np.linalg.norm(q)])
    return out


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, k: int,
                    seed: int = SEED) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``k`` largest eigenvalues in falling order, their unit vectors as
    columns, and the largest residual over the largest eigenvalue. The
    matrix is known by its ``product`` with a few columns alone."""
    rng = np.random.default_rng(seed)
    locked, values = np.empty((d, 0)), []
    space = orthonormal(rng.standard_normal((d, min(d, 2 * k))), locked)
    image = product(space)
    scale, best, idle = 0.0, np.inf, 0
    for _ in range(ROUNDS):
        theta, turn = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        scale = max(scale, float(theta[0]) if len(theta) else 0.0)
        want = min(k - len(values), space.shape[1])
        residual = image[:, :want] - space[:, :want] * theta[:want]
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        # Where rounding in the passes keeps residuals from falling further,
        # six idle rounds below FLOOR are the precision that is to be had.
        worst = float(size.max(initial=0.0))
        best, idle = (worst, 0) if worst < best / 2 else (best, idle + 1)
        bad = size > (PRECISION if idle < 6 else FLOOR) * scale
        ready = int(np.argmax(bad)) if bad.any() else want
        if ready:  # locked in order, so that none is passed over
            locked = np.column_stack([locked, space[:, :ready]])
            values += theta[:ready].tolist()
            space, image, theta = space[:, ready:], image[:, ready:], theta[ready:]
            residual = residual[:, ready:]
            want, best, idle = want - ready, np.inf, 0
        if len(values) >= k or not want:
            break
        if space.shape[1] > BASIS * k:
            space, image, theta = space[:, :3 * k], image[:, :3 * k], theta[:3 * k]
        near = np.column_stack([locked, space[:, :want]])

        def outside(z: np.ndarray) -> np.ndarray:
            return z - near @ (near.T @ z)

        def corrected(z: np.ndarray, shift: np.ndarray = theta[:want]) -> np.ndarray:
            z = outside(z)
            return outside(product(z) - z * shift)

        steps = minres(corrected, -outside(residual), INNER, 1e-3)
        new = orthonormal(np.column_stack([steps, residual]), np.column_stack([locked, space]))
        if not new.shape[1]:  # nothing to add: the space holds all there is
            new = orthonormal(rng.standard_normal((d, k)), np.column_stack([locked, space]))
            if not new.shape[1]:
                ready = k - len(values)
                locked = np.column_stack([locked, space[:, :ready]])
                values += theta[:ready].tolist()
                break
        space, image = np.column_stack([space, new]), np.column_stack([image, product(new)])
    else:
        raise RuntimeError(f"residuals did not reach double precision in {ROUNDS} rounds")
    # A product of their own: values and residuals as they are now.
    locked = orthonormal(locked, np.empty((d, 0)))
    image = product(locked)
    theta, turn = np.linalg.eigh((locked.T @ image + image.T @ locked) / 2)
    theta, turn = theta[::-1], turn[:, ::-1]
    vectors, image = locked @ turn, image @ turn
    worst = np.linalg.norm(image - vectors * theta, axis=0).max(initial=0.0)
    return theta, vectors, float(worst / scale) if scale > 0 else 0.0


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained,
    identity_error, deviation_exact of every remaining row and component.

    Rows with a null or empty vector, null or non-finite entries, or another
    length than most vectors have, are left out of fit and result. Repeated
    rows count and come back as often as they occur, rows with a null
    ``vec_id`` too. There are as many components as dimensions when those
    are fewer. Where eigenvalues tie, any orthonormal basis of their space
    is taken. A component without variance (all vectors equal, or fewer
    vectors than components) has null ``whitened``, ``explained`` 0 and no
    part in ``identity_error``. ``deviation`` is null where it does not fit
    a long; ``deviation_exact`` (decimal) holds it there too. Entries
    beyond 2**52 in size are outside the integer form. Extra columns are
    ignored; an empty table gives an empty result.
    """
    vectors = integer_vectors(embeddings)
    n, sums = column_sums(vectors)
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double, deviation_exact decimal(38,0)")
    if not n:
        return embeddings.sparkSession.createDataFrame([], schema)
    d = len(sums)
    k = min(components, d)
    trace = float(add_up(vectors, n, sums, lambda c: np.array([(c * c).sum()]), (1,))[0]) / n
    values, units, _ = jacobi_davidson(covariance_product(vectors, n, sums), d, k)
    live = values > d * np.finfo(float).eps * max(trace, 0.0)
    project = units[:, live] / np.sqrt(values[live])
    m = project.shape[1]
    # The whitened table's own covariance, centred by its own mean.
    mean = add_up(vectors, n, sums, lambda c: (c @ project).sum(axis=0), (m,)) / n
    def gram(c: np.ndarray) -> np.ndarray:
        z = c @ project - mean
        return z.T @ z
    error = float(np.abs(add_up(vectors, n, sums, gram, (m, m)) / n - np.eye(m)).max(initial=0.0))
    explained = np.where(live, values / trace if trace > 0 else 0.0, 0.0)
    kind = pa.schema([
        ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
        ("deviation_exact", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2048):
            if not part.num_rows:
                continue
            off = deviations(matrix(part.column(1)), n, sums)
            total = squares(off)
            z = np.full((len(off), k), np.nan)
            z[:, live] = (off.astype(float) / n) @ project
            each = lambda items: list(chain.from_iterable([x] * k for x in items))
            yield batch(
                kind, part.column(0).take(pa.array(np.repeat(np.arange(len(off)), k))),
                np.tile(np.arange(1, k + 1, dtype=np.int32), len(off)), np.full(len(off) * k, n),
                each(t if t <= LONG_MAX else None for t in total),
                pa.array(z.ravel(), from_pandas=True), np.tile(explained, len(off)),
                np.full(len(off) * k, error), each(map(Decimal, total)))

    return vectors.select("vec_id", "x").mapInArrow(run, schema)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
