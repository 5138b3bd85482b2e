"""Whitening of embeddings by an incremental eigendecomposition.

Each task goes through its vectors and keeps count, mean, eigenvalues and eigenvectors of their scatter. A vector is a
centred rank-one update: its secular equation gives the new eigenvalues, after deflation of the directions that the
vector does not change, and the eigenvectors are turned by the matrix that belongs to them. The spectra of the tasks
are combined in a tree: those of one are added to the other's as successive rank-one updates, and the difference of
the means as one more. A last pass over all vectors projects the exactly centred rows on that basis; the eigenvectors
of the small matrix of their products turn it into the eigenvectors of the covariance (Rayleigh-Ritz). As the basis
is complete, they are exact but for rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.llm.vectors import finite, floors, record, tree
from timberline.session import Workspace, materialize

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Integers below these are exact in a double, and fit a long.
EXACT, LONG = 1 << 53, 1 << 63

_EPS = np.finfo(float).eps
_STEPS = 80
_SPECTRUM = "width int, part long, n long, sums binary, mean binary, values binary, basis binary"
_PRODUCTS = "part long, sums binary, products binary"


def secular(poles: np.ndarray, squares: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1/weight + sum(squares / (poles - x)): ``roots, poles - roots`` as a matrix (root, pole).

    The poles rise strictly and there is a root behind each. A root is searched for as its distance from the nearer of
    the poles around it, so that small distances keep all digits; the search fits a curve of two poles to both sides
    and halves the interval where the fit leaves it.
    """
    k = poles.size
    ends = np.append(poles[1:], poles[-1] + weight * squares.sum())
    own, rows = np.arange(k), np.arange(k)
    half = (ends - poles) / 2
    at_half = 1 / weight + (squares / (poles - (poles + half)[:, None])).sum(1)
    right = (at_half < 0) & (own < k - 1)
    origin = own + right
    low = np.where(right, -half, np.where(at_half < 0, half, 0.0))
    high = np.where(right, 0.0, np.where(at_half < 0, 2 * half, half))
    apart = poles - poles[origin][:, None]
    behind = np.tri(k)
    following = np.minimum(own + 1, k - 1)
    y = (low + high) / 2
    todo = np.ones(k, bool)
    for _ in range(_STEPS):
        gap = apart - y[:, None]
        terms = squares / gap
        total = terms.sum(1)
        f = 1 / weight + total
        low, high = np.where(f < 0, y, low), np.where(f >= 0, y, high)
        # Terms of the poles behind are negative, the others positive.
        todo &= np.abs(f) > 4 * _EPS * (1 / weight + total - 2 * np.einsum("ij,ij->i", terms, behind))
        todo &= high - low > 2 * _EPS * np.maximum(np.abs(low), np.abs(high))
        if not todo.any():
            break
        slopes = terms / gap
        left_slope = np.einsum("ij,ij->i", slopes, behind)
        right_slope = slopes.sum(1) - left_slope
        left = gap[rows, own]
        after = np.where(own < k - 1, gap[rows, following], ends - poles[origin] - y)
        a = (left + after) * f - left * after * (left_slope + right_slope)
        b = left * after * f
        c = f - left * left_slope - after * right_slope
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = y + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        y = np.where(todo, np.where(inside, new, (low + high) / 2), y)
    return poles[origin] + y, apart - y[:, None]


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Rising eigenvalues and eigenvectors (columns) of ``basis @ diag(values) @ basis.T + weight * outer(vector, vector)``."""
    z = basis.T @ vector
    length = float(np.sqrt(z @ z))
    if length == 0 or weight <= 0:
        return values, basis
    least = 8 * _EPS * max(float(values[-1]), weight * length * length)
    # Equal eigenvalues: a reflection inside of their space leaves one direction that the vector touches.
    close = np.diff(values) <= least
    if close.any():
        basis = basis.copy()
        edges = np.flatnonzero(np.diff(np.concatenate([[False], close, [False]]).astype(np.int8)))
        for start, stop in zip(edges[::2], edges[1::2]):
            group = slice(start, stop + 1)
            mirror = z[group].copy()
            size = float(np.sqrt(mirror @ mirror))
            if size == 0:
                continue
            sign = 1.0 if mirror[-1] >= 0 else -1.0
            mirror[-1] += sign * size
            basis[:, group] -= np.outer(basis[:, group] @ mirror, mirror * (2 / (mirror @ mirror)))
            z[group] = 0
            z[stop] = -sign * size
    # Directions that the vector hardly touches stay as they are.
    touched = np.flatnonzero(weight * length * np.abs(z) > least)
    if touched.size == 0:
        return values, basis
    poles = values[touched]
    roots, gaps = secular(poles, z[touched] ** 2, weight)
    # The vector for which these roots are exact, so that the eigenvectors come out orthogonal.
    k = touched.size
    below = np.arange(k)[:, None] < np.arange(k)
    apart = np.where(below, poles[:, None], np.append(poles[1:], poles[-1] + 1)[:, None]) - poles
    apart[-1] = 1
    fitted = np.sqrt(np.abs(np.prod(-gaps / apart, axis=0)))
    turn = fitted * np.where(z[touched] < 0, -1.0, 1.0) / gaps
    turn /= np.sqrt((turn * turn).sum(1))[:, None]
    values, old = values.copy(), basis
    values[touched] = roots
    basis = old.copy()
    basis[:, touched] = old[:, touched] @ turn.T
    order = np.argsort(values, kind="stable")
    return np.maximum(values[order], 0), basis[:, order]


class Spectrum:
    """Count, exact sums, mean, and eigenvalues and eigenvectors of the scatter around it."""

    def __init__(self, n: int, sums: np.ndarray, mean: np.ndarray, values: np.ndarray, basis: np.ndarray):
        self.n, self.sums, self.mean, self.values, self.basis = n, sums, mean, values, basis

    @classmethod
    def empty(cls, width: int) -> Spectrum:
        return cls(0, np.zeros(width, np.int64), np.zeros(width), np.zeros(width), np.eye(width))

    def add(self, vector: np.ndarray) -> None:
        self.n += 1
        away = vector - self.mean
        self.mean = self.mean + away / self.n
        self.values, self.basis = rank_one(self.values, self.basis, away, (self.n - 1) / self.n)

    def combine(self, other: Spectrum) -> None:
        if other.n == 0:
            return
        n, away = self.n + other.n, other.mean - self.mean
        for value, direction in zip(other.values, other.basis.T):
            if value > 0:
                self.values, self.basis = rank_one(self.values, self.basis, direction, float(value))
        self.values, self.basis = rank_one(self.values, self.basis, away, self.n * other.n / n)
        self.mean = self.mean + away * (other.n / n)
        self.n, self.sums = n, self.sums + other.sums

    def packed(self) -> tuple:
        return self.n, self.sums.tobytes(), self.mean.tobytes(), self.values.tobytes(), self.basis.tobytes()

    @classmethod
    def unpacked(cls, row) -> Spectrum:
        numbers = [np.frombuffer(x, "<f8").copy() for x in (row.mean, row.values, row.basis)]
        width = numbers[0].size
        return cls(int(row.n), np.frombuffer(row.sums, "<i8").copy(), numbers[0], numbers[1], numbers[2].reshape(width, width))


def entries(values: np.ndarray) -> np.ndarray:
    """Entries as long integers: floor(SCALE * c) + SHIFT."""
    return floors(values, SCALE, EXACT // 2).astype(np.int64) + SHIFT


def rows_of(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def spectra(embeddings: DataFrame) -> DataFrame:
    """A row for each task and width: the spectrum of its vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found: dict[int, Spectrum] = {}
        for batch in batches:
            for width, (_, values) in finite(batch.column(1)).items():
                own = found.setdefault(width, Spectrum.empty(width))
                x = entries(values)
                own.sums = own.sums + x.sum(0)
                for vector in x.astype(np.float64):
                    own.add(vector)
        for width, own in found.items():
            yield record(_SPECTRUM, width, TaskContext.get().partitionId(), *own.packed())

    return embeddings.mapInArrow(run, _SPECTRUM)


def combined(tables: pd.DataFrame) -> pd.DataFrame:
    rows = list(tables.sort_values("n", ascending=False).itertuples(index=False))
    first = Spectrum.unpacked(rows[0])
    for row in rows[1:]:
        first.combine(Spectrum.unpacked(row))
    n, sums, mean, values, basis = first.packed()
    return pd.DataFrame({"width": [rows[0].width], "part": [rows[0].part], "n": [n], "sums": [sums], "mean": [mean], "values": [values], "basis": [basis]})


def centred(values: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact."""
    x = entries(values)
    if x.size and int(np.abs(x).max()) * n >= LONG // 2:
        raise OverflowError("count times entry does not fit a long")
    return n * x - sums


def deviations(away: np.ndarray) -> np.ndarray:
    """Sums of squares of the rows, exact; raises where one does not fit a long."""
    if away.size and int(np.abs(away).max()) ** 2 * away.shape[1] >= LONG:
        exact = [sum(int(v) * int(v) for v in row) for row in away]
        if max(exact) >= LONG:
            raise OverflowError("a deviation does not fit a long")
        return np.array(exact, np.int64)
    return (away * away).sum(1)


def products(table: DataFrame, matrix_of) -> DataFrame:
    """For each task, sums and sums of products of the columns of ``matrix_of(batch)``, a row at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sums = both = None
        for batch in batches:
            rows = matrix_of(batch)
            if rows is None or not len(rows):
                continue
            sums = rows.sum(0) + (0 if sums is None else sums)
            both = rows.T @ rows + (0 if both is None else both)
        if both is not None:
            yield record(_PRODUCTS, TaskContext.get().partitionId(), sums.tobytes(), both.tobytes())

    return table.mapInArrow(run, _PRODUCTS)


def added(tables: pd.DataFrame) -> pd.DataFrame:
    total = {name: sum(np.frombuffer(x, "<f8") for x in tables[name]).tobytes() for name in ("sums", "products")}
    return pd.DataFrame({"part": tables["part"][:1], "sums": [total["sums"]], "products": [total["products"]]})


def summed(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sums and products over all rows; they have the size of a matrix of the width."""
    parts = (table.agg(F.max("part").alias("last")).first().last or 0) + 1
    row = tree(table, [], parts, added).first()
    sums = np.frombuffer(row.sums, "<f8")
    return sums, np.frombuffer(row.products, "<f8").reshape(sums.size, sums.size)


def fitted(embeddings: DataFrame, kept: Workspace) -> tuple[Spectrum, np.ndarray, np.ndarray] | None:
    """Count and sums of the fit list, falling eigenvalues of its covariance and their eigenvectors as columns."""
    first = kept(spectra(embeddings), "spectra")
    last = first.agg(F.max("part").alias("last")).first().last
    if last is None:
        return None
    found = tree(first, ["width"], last + 1, combined)
    whole = Spectrum.unpacked(found.orderBy(F.desc("n"), F.desc("width")).first())
    n, sums, width = whole.n, whole.sums, whole.sums.size
    start, _ = np.linalg.qr(whole.basis[:, ::-1])

    def projected(batch: pa.RecordBatch):
        own = finite(batch.column(1)).get(width)
        return None if own is None else (centred(own[1], n, sums) / n) @ start

    _, both = summed(kept(products(embeddings, projected), "products"))
    values, turn = np.linalg.eigh((both + both.T) / (2 * n))
    values, basis = values[::-1], (start @ turn)[:, ::-1]
    basis = basis / np.sqrt((basis * basis).sum(0))
    signs = np.where(basis[np.abs(basis).argmax(0), np.arange(width)] < 0, -1.0, 1.0)
    return whole, np.maximum(values, 0), basis * signs


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for rows of ``vec_id, embedding``.

    Rows whose vector is null, empty or holds a null or a number that is not finite are dropped. If vectors have
    several widths, those of the most frequent one (the larger of equally frequent ones) are the fit list and the others
    are dropped. Directions without variance cannot be whitened and have no rows, so a single vector, equal vectors and
    an empty table give an empty result. Repeated rows count as often as they occur; a row without an id
    has its rows without one; other columns are ignored. Numbers that do not fit a long raise.
    """
    spark, schema = embeddings.sparkSession, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = rows_of(embeddings)
    with Workspace(spark, "whitening") as kept:
        model = fitted(rows, kept)
        if model is None:
            return spark.createDataFrame([], schema)
        whole, values, basis = model
        n, sums, width = whole.n, whole.sums, whole.sums.size
        count = min(components, int((values > values[0] * width * _EPS).sum()))
        if count == 0:
            return spark.createDataFrame([], schema)
        trace, directions = float(values.sum()), basis[:, :count] / np.sqrt(values[:count])

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = finite(batch.column(1)).get(width)
                if own is None:
                    continue
                away = centred(own[1], n, sums)
                flat = (away / n) @ directions
                places = pa.array(np.arange(len(flat) + 1, dtype=np.int32) * count)
                lists = pa.ListArray.from_arrays(places, pa.array(flat.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own[0])), pa.array(deviations(away)), lists], names=["vec_id", "deviation", "whitened"]
                )

        result = materialize(rows.mapInArrow(project, "vec_id long, deviation long, whitened array<double>"), "whitened")

        def whitened(batch: pa.RecordBatch):
            return batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, count)

        total, both = summed(kept(products(result, whitened), "identity"))
    covariance = both / n - np.outer(total / n, total / n)
    error = float(np.abs(covariance - np.eye(count)).max())
    explained = F.lit([float(x) for x in values[:count] / trace])
    return result.select("vec_id", "deviation", F.posexplode("whitened").alias("_place", "whitened")).select(
        "vec_id",
        (F.col("_place") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("_place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector of ``embeddings`` on up to 32 components; see ``whiten`` for nulls and empty tables."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
