"""Whitening of embeddings by an incremental eigendecomposition.

Entries become whole numbers ``x``, and the fit list holds each distinct vector once. Every task walks over its part of that
list and keeps a spectrum: how many vectors, their exact sums, the eigenvalues and eigenvectors of their scatter about their
mean. A block of rows is centred and condensed to the triangle of its QR factorisation, which has the same scatter in at most
as many rows as dimensions (``block=1`` leaves single vectors); each of these rows, and the distance between the block's mean
and the mean so far, is a centred rank-one update

    Q diag(d) Q' + v v'  =  (Q U) diag(d') (Q U)',

whose ``d'`` are the roots of the secular equation ``1 + sum z_i^2 / (d_i - t) = 0`` with ``z = Q'v``. Coordinates that hardly
take part (``z_i`` about zero) and equal eigenvalues are deflated: they keep their value, the latter after a rotation that
moves their weight into one of them. ``U`` follows from weights recomputed from the roots, which keeps it orthogonal.
Spectra of tasks are merged in groups of ``FAN_IN``, again by rank-one updates, one for each eigenvector of the other
spectrum and one for the distance of the means, until one is left. A last distributed pass refines it: the covariance is
summed in the coordinates of the eigenvectors found (Rayleigh-Ritz), where it is all but diagonal, and its own
eigenvectors turn the basis into the components.

The driver sees matrices of dimension by dimension, never rows. What a task holds is one batch and such matrices.

Rows are dropped when the vector is null, empty, holds a null or non-finite entry, has an entry whose ``x`` is beyond 2^53 (no
longer exact), or has not the table's most frequent length (of equally frequent ones the greater). Repeated rows each get
their rows of the result and count once in the fit. Components without variance cannot be whitened and have no row; so a
table whose rows are all equal, like an empty one, gives no rows. ``deviation`` is null where it does not fit into a long. A
null ``vec_id`` is kept as null. Columns other than the two are not read.
"""

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from speechframe.llm.common import map_batches
from speechframe.session import materialize

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Rows that are condensed together before the rank-one updates.
BLOCK = 4_096
#: Spectra merged by one task.
FAN_IN = 8
EXACT = 2.0**53
EPS = np.finfo(np.float64).eps
#: Eigenvalues below this share of the largest are rounding, not variance.
LEAST_SHARE = 1e-13

FIT = "width int, x binary"
SPECTRUM = "part int, n long, sums array<long>, mean array<double>, values array<double>, vectors binary"


# vectors as whole numbers


def whole(batch) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows of a batch whose vector can be used, and for each the whole numbers ``floor(64 c)`` as float64, without the offset."""
    column = batch.column("embedding")
    # nulls arrive as NaN
    flat = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False) if len(column.values) else np.empty(0)
    with np.errstate(over="ignore"):
        x = np.floor(flat * SCALE)
    ends = column.offsets.to_numpy()
    bad = np.concatenate([[0], np.cumsum(~(np.abs(x) < EXACT - OFFSET))])
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (np.diff(ends) > 0) & (bad[ends[1:]] == bad[ends[:-1]])
    rows = np.flatnonzero(usable)
    return rows, [x[ends[i] : ends[i + 1]] for i in rows]


def _packed(x: np.ndarray) -> bytes:
    """Eight, two or one bytes an entry, the least that holds the vector, so that equal vectors have equal bytes."""
    top = np.abs(x).max()
    kind = np.int8 if top < 2**7 else np.int16 if top < 2**15 else np.int64
    return x.astype(kind).tobytes()


def _unpacked(column, width: int) -> np.ndarray:
    """Rows of whole numbers, with the offset, of one batch of packed vectors that all have ``width`` entries."""
    packed = column.to_pylist()
    out = np.empty((len(packed), width), dtype=np.int64)
    sizes = np.array(list(map(len, packed)), dtype=np.int64)
    for kind in (np.int8, np.int16, np.int64):
        rows = np.flatnonzero(sizes == width * np.dtype(kind).itemsize)
        out[rows] = np.frombuffer(b"".join(packed[i] for i in rows), dtype=kind).reshape(-1, width)
    return out + OFFSET


def fit_list(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """The written table (width, x) of distinct packed vectors of the most frequent length, and that length."""

    def pack(batches):
        for batch in batches:
            vectors = whole(batch)[1]
            yield pa.RecordBatch.from_pydict({"width": pa.array([len(x) for x in vectors], pa.int32()), "x": pa.array([_packed(x) for x in vectors], pa.binary())})

    packed = map_batches(embeddings.select("embedding"), pack, FIT)
    # a frequent vector is folded in each task before the shuffle
    counted = materialize(packed.groupBy("width", "x").agg(F.count("*").alias("n")), "vectors")
    widths = counted.groupBy("width").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    width = widths["width"] if widths else 0
    return counted.filter(F.col("width") == width).select("width", "x"), width


# rank-one updates


def _secular_roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum w_i / (d_i - t)`` for rising distinct ``d`` and positive ``w``, each as (pole, distance from it).

    The j-th root lies between ``d_j`` and the next pole (the last within the sum of ``w``). It is found by bisection on the
    distance from the nearer pole, which is what the eigenvectors need to full precision, steps of a rational fit going first.
    """
    n = len(d)
    gap = np.append(np.diff(d), w.sum())
    apart = d[None, :] - d[:, None]  # d_i - d_j
    middle = gap / 2
    at_middle = 1 + (w[None, :] / (apart - middle[:, None])).sum(axis=1)
    pole = np.arange(n)
    right = (at_middle < 0) & (pole < n - 1)
    pole[right] += 1
    from_pole = d[None, :] - d[pole][:, None]
    low = np.where(right, -middle, np.where(at_middle < 0, middle, 0.0))
    high = np.where(right, 0.0, np.where((at_middle < 0) & ~right, gap, middle))
    t = (low + high) / 2
    # the two poles that enclose a root; the last root has only the one below
    below, above = np.arange(n), np.minimum(np.arange(n) + 1, n - 1)
    index = np.arange(n)
    split, last = index[None, :] <= index[:, None], index == n - 1
    done = np.zeros(n, dtype=bool)
    for _ in range(80):
        delta = from_pole - t[:, None]
        terms = w[None, :] / delta
        value = 1 + terms.sum(axis=1)
        low, high = np.where(value < 0, t, low), np.where(value < 0, high, t)
        done |= (np.abs(value) <= EPS * n * (1 + np.abs(terms).sum(axis=1))) | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
        if done.all():
            break
        slopes = terms / delta
        psi, phi = np.where(split, slopes, 0).sum(axis=1), np.where(split, 0, slopes).sum(axis=1)
        # fit c + s / (d_below - t) + r / (d_above - t) with the value and both slopes, and take its root in between
        db, da = delta[index, below], delta[index, above]
        c = value - db * psi - np.where(last, 0, da * phi)
        a = (db + da) * value - db * da * (psi + phi)
        b = db * da * value
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = t + np.where(last, db * value / (value - db * psi), step)
        t = np.where(done, t, np.where((new > low) & (new < high), new, (low + high) / 2))
    return pole, t


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) of ``vectors diag(values) vectors' + v v'``."""
    z = vectors.T @ v
    weight = z @ z
    if weight == 0:
        return values, vectors
    limit = 8 * EPS * max(values[-1], weight)
    # equal eigenvalues: a rotation moves the weight of the first into the second
    vectors = vectors.copy()
    for i in np.flatnonzero(np.diff(values) <= limit):
        norm = np.hypot(z[i], z[i + 1])
        if norm > 0:
            c, s = z[i + 1] / norm, z[i] / norm
            vectors[:, [i, i + 1]] = vectors[:, [i, i + 1]] @ np.array([[c, s], [-s, c]])
            z[i], z[i + 1] = 0.0, norm
    active = np.flatnonzero(np.abs(z) * np.sqrt(weight) > limit)
    if not len(active):
        return values, vectors
    d = values[active]
    pole, t = _secular_roots(d, z[active] ** 2)
    new = d[pole] + t
    # d_i - root_j, exact to the last digits since a root is known by its distance from a pole
    differ = (d[:, None] - d[pole][None, :]) - t[None, :]
    # weights for which the roots are exact (Gu and Eisenstat), so that the eigenvectors are orthogonal
    n = len(d)
    ratio = -differ
    with np.errstate(all="ignore"):
        spread = d[None, :] - d[:, None]
        np.fill_diagonal(spread, 1.0)
        squares = np.prod(ratio / np.where(spread == 0, 1.0, spread), axis=1)
    own = np.sqrt(np.abs(squares)) * np.sign(z[active])
    u = own[:, None] / differ
    u /= np.sqrt((u * u).sum(axis=0))
    values, out = values.copy(), vectors
    values[active] = new
    out[:, active] = vectors[:, active] @ u
    order = np.argsort(values, kind="stable")
    return values[order], out[:, order]


class Spectrum:
    """Count, exact sums, mean, and the eigenvalues and eigenvectors of the scatter about the mean."""

    def __init__(self, n: int, sums, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.n, self.sums, self.mean, self.values, self.vectors = n, list(sums), mean, values, vectors

    @classmethod
    def empty(cls, width: int) -> "Spectrum":
        return cls(0, [0] * width, np.zeros(width), np.zeros(width), np.eye(width))

    def _apply(self, rows, n: int, sums) -> None:
        """Take in ``n`` vectors with these sums, whose scatter about their mean is that of the centred ``rows``."""
        mean = np.array([s / n for s in sums])
        if self.n:
            far = (mean - self.mean) * np.sqrt(self.n * n / (self.n + n))
            rows = [*rows, far]
        for v in rows:
            self.values, self.vectors = rank_one(self.values, self.vectors, v)
        self.n += n
        self.sums = [a + b for a, b in zip(self.sums, sums)]
        self.mean = np.array([s / self.n for s in self.sums])

    def add(self, x: np.ndarray) -> None:
        """Take in a block of vectors."""
        sums = [int(s) for s in x.sum(axis=0, dtype=np.int64)] if np.abs(x).max() < 2**62 // len(x) else [sum(map(int, c)) for c in x.T]
        centred = x - np.array([s / len(x) for s in sums])
        rows = np.linalg.qr(centred, mode="r") if len(x) > 1 else centred[:0]
        self._apply(list(rows), len(x), sums)

    def merge(self, other: "Spectrum") -> None:
        if other.n:
            rows = (other.vectors * np.sqrt(np.maximum(other.values, 0))).T
            self._apply([r for r, e in zip(rows, other.values) if e > 0], other.n, other.sums)

    def row(self, part: int) -> dict:
        return {"part": [part], "n": [self.n], "sums": [self.sums], "mean": [self.mean.tolist()], "values": [self.values.tolist()], "vectors": [self.vectors.tobytes()]}

    @classmethod
    def of(cls, row: dict) -> "Spectrum":
        width = len(row["values"])
        return cls(row["n"], row["sums"], np.array(row["mean"]), np.array(row["values"]), np.frombuffer(row["vectors"]).reshape(width, width).copy())


def spectrum(fit: DataFrame, width: int, block: int = BLOCK) -> Spectrum:
    """The spectrum of a fit list: one per task, merged in groups until one is left."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(SPECTRUM))

    def own(batches):
        found = Spectrum.empty(width)
        for batch in batches:
            x = _unpacked(batch.column("x"), width)
            for at in range(0, len(x), block):
                found.add(x[at : at + block])
        if found.n:
            yield pa.RecordBatch.from_pydict(found.row(TaskContext.get().partitionId()), schema=schema)

    def merged(key, table):
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        found = Spectrum.of(rows[0])
        for r in rows[1:]:
            found.merge(Spectrum.of(r))
        return pa.table(found.row(key[0].as_py()), schema=schema)

    tasks = materialize(map_batches(fit.select("x"), own, SPECTRUM), "spectra")
    while tasks.count() > 1:
        grouped = tasks.withColumn("group", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("group")
        tasks = materialize(grouped.applyInArrow(merged, SPECTRUM), "spectra")
    row = tasks.first()
    return Spectrum.of(row.asDict()) if row else Spectrum.empty(width)


# refinement, projection


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n x - S``, exact: whole numbers of the machine where they fit, else Python's."""
    if n * int(np.abs(x).max(initial=0)) < 2**62 and max(map(abs, sums), default=0) < 2**62:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - S/n``, rounded once."""
    return _deviations(x, n, sums).astype(np.float64) / n


def _summed(fit: DataFrame, width: int, n: int, sums: list[int], basis: np.ndarray) -> np.ndarray:
    """The covariance of the fit list in the coordinates of ``basis`` (columns), summed over tasks."""
    size = basis.shape[1]
    # pieces of a few entries, so that no row is longer than the basis is wide
    schema = "line int, sums array<double>"

    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            y = centred(_unpacked(batch.column("x"), width), n, sums) @ basis
            total += y.T @ y
        yield pa.RecordBatch.from_pydict({"line": pa.array(range(size), pa.int32()), "sums": pa.array(total.tolist(), pa.list_(pa.float64()))})

    lines = map_batches(fit.select("x"), run, schema)
    cells = lines.select("line", F.posexplode("sums").alias("at", "v")).groupBy("line", "at").agg(F.sum("v").alias("v"))
    out = np.zeros((size, size))
    for line, at, v in cells.collect():  # as many cells as the basis has entries
        out[line, at] = v / n
    return (out + out.T) / 2


def components(fit: DataFrame, width: int, block: int = BLOCK):
    """(n, sums, eigenvalues falling, components as columns, trace) of the fit list, refined to double precision."""
    found = spectrum(fit, width, block)
    if not found.n:
        return 0, [], np.empty(0), np.empty((width, 0)), 0.0
    basis = np.linalg.qr(found.vectors[:, ::-1])[0]
    small = _summed(fit, width, found.n, found.sums, basis)
    values, turn = np.linalg.eigh(small)
    return found.n, found.sums, values[::-1], (basis @ turn)[:, ::-1], float(np.trace(small))


def whiten(embeddings: DataFrame, most: int = COMPONENTS, block: int = BLOCK) -> DataFrame:
    """(vec_id, n, deviation, whitened array<double>, explained array<double>, identity_error) of every row that is not dropped."""
    fit, width = fit_list(embeddings)
    n, sums, values, vectors, trace = components(fit, width, block)
    kept = int((values[:most] > LEAST_SHARE * values[0]).sum()) if len(values) and values[0] > 0 else 0
    scaled = vectors[:, :kept] / np.sqrt(values[:kept])
    error = float(np.abs(_summed(fit, width, n, sums, scaled) - np.eye(kept)).max()) if kept else 0.0
    id_type = embeddings.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows, vectors = whole(batch)
            fits = np.array([len(x) == width for x in vectors], dtype=bool)
            x = np.array([v for v, f in zip(vectors, fits) if f], dtype=np.float64).reshape(-1, width).astype(np.int64) + OFFSET
            apart = _deviations(x, n, sums)
            if apart.dtype == object or np.abs(apart).max(initial=0) >= isqrt(2**63 // width):
                squares = [int(s) for s in (apart.astype(object) ** 2).sum(axis=1)]
                squares = [s if s < 2**63 else None for s in squares]
            else:
                squares = (apart**2).sum(axis=1)
            white = (apart.astype(np.float64) / n) @ scaled
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows[fits])), pa.array(squares, pa.int64()), pa.array(white.tolist(), pa.list_(pa.float64()))],
                ["vec_id", "deviation", "whitened"],
            )

    if not kept:
        schema = f"vec_id {id_type}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
        return embeddings.sparkSession.createDataFrame([], schema)
    out = map_batches(embeddings.select("vec_id", "embedding"), run, f"vec_id {id_type}, deviation long, whitened array<double>")
    explained = F.array(*(F.lit(float(v / trace)) for v in values[:kept]))
    return out.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))


def by_component(whitened: DataFrame) -> DataFrame:
    """One row for each vector and component, numbered from 1."""
    each = whitened.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened", F.element_at("explained", F.col("at") + 1).alias("explained"), "identity_error"
    )
