"""Whitening of vectors along the leading components of their covariance.

Entries are taken as whole numbers, so that sums are exact. Tasks reduce their rows to the sum
and the centred products of each, which are put together by Spark; only the d x d
covariance and its leading eigenpairs (``spectrum_slicing``) are handled by the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.spectrum_slicing import leading
from tarnlake.llm.staging import Stage

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries whose whole number would leave this range count as infinite.
MOST = float(1 << 61)
#: Values of a batch that are centred at once.
AT_ONCE = 1 << 20


def sound(vector: Column) -> Column:
    """Whether a vector is there and all its entries are numbers in range."""
    whole = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < MOST / SCALE)
    return F.coalesce(vector.isNotNull() & F.forall(vector, whole), F.lit(False))


def whole_entries(column: pa.Array, dim: int) -> np.ndarray:
    """The entries of a batch of vectors as whole numbers, one row per vector."""
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return np.floor(SCALE * entries).astype(np.int64) + SHIFT


def _parts(batch: pa.RecordBatch, column: str, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    step = max(1, AT_ONCE // max(dim, 1))
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        yield part, whole_entries(part.column(column), dim)


#: What a task knows of its rows: one row for each dimension i. Sums are in two halves, which do
#: not overflow; ``products`` are row i of the products centred on the task's own mean.
MOMENT_SCHEMA = "task long, i int, n long, high long, low long, mean array<double>, products array<double>"


class Moments:
    """Count, exact sum and centred products of rows, gathered part by part."""

    def __init__(self, dim: int) -> None:
        self.n = 0
        self.high, self.low = np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        self.mean, self.products = np.zeros(dim), np.zeros((dim, dim))

    def add(self, rows: np.ndarray) -> None:
        """Chan's update, with rows centred before they are multiplied."""
        n = len(rows)
        if n == 0:
            return
        self.high += (rows >> 31).sum(axis=0)
        self.low += (rows & ((1 << 31) - 1)).sum(axis=0)
        base = rows[0]
        mean = base + (rows - base).mean(axis=0)
        centred = (rows - base) - (mean - base)
        gap = mean - self.mean
        both = self.n + n
        self.products += centred.T @ centred + np.outer(gap, gap) * (self.n * n / both)
        self.mean += gap * (n / both)
        self.n = both


def _moments(column: str, dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        moments = Moments(dim)
        for batch in batches:
            for _, rows in _parts(batch, column, dim):
                moments.add(rows)
        if moments.n == 0:
            return
        task, lists = TaskContext.get().partitionId(), pa.list_(pa.float64())
        for i in range(dim):  # row by row, so that no batch holds the whole matrix again
            yield pa.RecordBatch.from_arrays(
                [pa.array([task]), pa.array([i], pa.int32()), pa.array([moments.n]), pa.array([moments.high[i]]),
                 pa.array([moments.low[i]]), pa.array([moments.mean if i == 0 else None], lists),
                 pa.array([moments.products[i]], lists)],
                ["task", "i", "n", "high", "low", "mean", "products"],
            )

    return gather


def _summed(parts: DataFrame, key: str, value: Column, weight: Column) -> DataFrame:
    """Sums of arrays, entry by entry, for each ``key``."""
    entries = parts.select(key, F.posexplode(F.transform(value, lambda x: x * weight)).alias("j", "x"))
    sums = entries.groupBy(key, "j").agg(F.sum("x").alias("x"))
    return sums.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("j", "x"))), lambda e: e["x"]).alias("x"))


@dataclass(frozen=True)
class Spectrum:
    """What whitening needs of the fit list: its size, exact sums and leading components."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """n * x - S, exactly; as Python's numbers where a long might not hold it."""
        biggest = max(map(abs, self.sums)) + self.n * max(int(rows.max()), -int(rows.min()))
        kind = object if biggest >= 1 << 62 else np.int64
        return self.n * rows.astype(kind) - np.asarray(self.sums, dtype=kind)

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        """Sum of squares of each row, exactly; null where a long does not hold it."""
        biggest = int(np.abs(centred).max())
        if centred.dtype == object or biggest * biggest * centred.shape[1] >= 1 << 63:
            sums = ((centred.astype(object)) ** 2).sum(axis=1)
            return [int(s) if s < 1 << 63 else None for s in sums]
        return (centred * centred).sum(axis=1).tolist()

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.n) @ (self.vectors / np.sqrt(self.values)[:, None]).T


def covariance(moments: DataFrame, dim: int) -> tuple[int, tuple[int, ...], np.ndarray]:
    """Count, exact sums and covariance (divisor n) of all tasks' rows.

    ``moments`` is a written table of ``MOMENT_SCHEMA``. Its parts are put together by Spark;
    what comes to the driver is one row for each dimension.
    """
    sums = moments.groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
        F.sum(F.col("low").cast("decimal(38,0)")).alias("low"),
    )
    told = {row["i"]: row for row in sums.collect()}
    n = told[0]["n"]
    total = tuple((int(told[i]["high"]) << 31) + int(told[i]["low"]) for i in range(dim))
    mean = [s / n for s in total]
    # Between the tasks: each task's mean against the whole's, weighted by its rows.
    means = moments.where("i = 0").select("task", "n", F.posexplode("mean").alias("j", "m"))
    whole = F.split(F.lit(",".join(map(repr, mean))), ",").cast("array<double>")
    gaps = means.select("task", "n", "j", (F.col("m") - F.get(whole, F.col("j"))).alias("gap"))
    per_task = gaps.groupBy("task", "n").agg(F.sort_array(F.collect_list(F.struct("j", "gap"))).alias("gaps"))
    outer = per_task.select(
        "n", F.transform("gaps", lambda e: e["gap"]).alias("gaps"), F.posexplode("gaps").alias("i", "g")
    ).select("i", F.col("gaps").alias("array"), (F.col("n") * F.col("g.gap")).alias("weight"))
    inner = moments.select("i", F.col("products").alias("array"), F.lit(1.0).alias("weight"))
    rows = _summed(inner.unionByName(outer), "i", F.col("array"), F.col("weight")).collect()
    matrix = np.zeros((dim, dim))
    for row in rows:
        matrix[row["i"]] = row["x"]
    return n, total, (matrix + matrix.T) / (2 * n)


def fit(rows: DataFrame, column: str, dim: int, stage: Stage, components: int = COMPONENTS) -> Spectrum:
    """The spectrum of all ``rows``, whose ``column`` holds sound vectors of length ``dim``."""
    moments = stage.put(rows.select(column).mapInArrow(_moments(column, dim), MOMENT_SCHEMA), "moments")
    n, sums, matrix = covariance(moments, dim)
    stage.drop(moments)
    values, vectors = leading(matrix, components)
    return Spectrum(n, sums, values, vectors, float(np.trace(matrix)))


def _projected(spectrum: Spectrum, dim: int):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, rows in _parts(batch, "embedding", dim):
                if len(rows) == 0:
                    continue
                centred = spectrum.centred(rows)
                white = spectrum.whitened(centred)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(spectrum.deviations(centred), pa.int64()),
                     pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * white.shape[1], white.ravel())],
                    ["vec_id", "deviation", "whitened"],
                )

    return project


def identity_error(projected: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity."""
    means = projected.agg(*[F.avg(F.get("whitened", F.lit(i))).alias(f"m{i}") for i in range(k)]).first()
    at = [F.get("whitened", F.lit(i)) - F.lit(float(means[i])) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = projected.agg(*[F.avg(at[i] * at[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[p] - (i == j)) for p, (i, j) in enumerate(pairs))


def whitened_vectors(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Each remaining vector along each leading component, one row for each of them.

    vec_id, component (from 1, by falling eigenvalue), n (vectors in the fit), deviation (the
    exact sum of squares of n * x - S, null where it exceeds a long), whitened, explained (the
    component's share of the variance) and identity_error (one value).

    ``vectors`` has ``vec_id`` and ``embedding``. Vectors that are null, or hold null, NaN or
    infinite entries (or entries of 2 ** 51 and more, whose whole number is out of range) are
    dropped; so are those whose length is not the one that most of the others have (the longest
    of these), empty ones included. Zero vectors stay, repeated rows count as often as they
    occur, a null vec_id is kept. Components whose variance is nothing but rounding are not
    given, so a single vector, or many equal ones, have none and no rows; no more has an empty
    table. Other columns are ignored.
    """
    stage = Stage(vectors.sparkSession, "whitening")
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(sound(F.col("embedding")))
    empty = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    nothing = vectors.sparkSession.createDataFrame([], empty)
    lengths = plain.groupBy(F.size("embedding").alias("dim")).count()
    usual = lengths.orderBy(F.desc("count"), F.desc("dim")).first()
    if usual is None or usual["dim"] == 0:
        return nothing
    dim = usual["dim"]
    plain = plain.where(F.size("embedding") == dim)
    spectrum = fit(plain, "embedding", dim, stage, components)
    k = len(spectrum.values)
    if k == 0:
        return nothing
    schema = "vec_id long, deviation long, whitened array<double>"
    projected = stage.put(plain.mapInArrow(_projected(spectrum, dim), schema), "projected")
    error = identity_error(projected, k)
    shares = F.split(F.lit(",".join(repr(float(v / spectrum.trace)) for v in spectrum.values)), ",").cast("array<double>")
    return projected.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(spectrum.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
