"""Nearest vectors by largest inner product: probed lists with an adaptive dimension scan.

With one coordinate more, which brings all vectors to the length of the longest, the largest
inner product is the smallest distance. Vectors are turned by a random rotation, so that the
first d of D coordinates of a difference are a sample of it, and scaled by D / d estimate its
square. A list is scanned in blocks of columns; after each block a candidate whose estimate is
beyond the query's current bound by more than the test allows is given up (ADSampling, Gao and
Long, 2023). Those that see all columns are scored on the original vectors.

Lists are those of the nearest of some centroids. A query first scans the nearest list, which
sets its bound for the others that it probes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.staging import Stage, small_or_not

#: Answers to a query.
NEAREST = 20
#: Every so many ids ask.
EVERY = 20
#: Bytes (as doubles) of the sample that centroids and probes are fitted on, whatever the table.
FIT_BYTES = 8 << 20
#: Rows a list should have, and most lists, which the driver fits.
LIST_ROWS, MOST_LISTS = 1024, 1024
#: Share of the sample's neighbours that the probed lists must hold.
COVERED = 0.98
#: Queries of the sample that the number of probes is fitted on.
FIT_QUERIES = 512
#: Columns of a block.
BLOCK = 8
#: The test's factor: the larger, the later a candidate is given up.
EPSILON = 2.1
#: Doubles of a tile of a list; it meets a tile of half as many doubles of queries.
TILE_DOUBLES = 1 << 19
#: Slack of the last bound, far above rounding.
SLACK = 1e-9


def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def extended(rows: np.ndarray, longest: float | None) -> np.ndarray:
    """Rows with the coordinate that brings them to ``longest``; 0 for queries (None)."""
    rest = np.zeros(len(rows)) if longest is None else np.sqrt(np.maximum(longest**2 - (rows * rows).sum(axis=1), 0))
    return np.c_[rows, rest]


def inner_products(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Row by row, added up from the first entry to the last, so that equal pairs have equal scores."""
    total = np.zeros(len(one))
    for i in range(one.shape[1]):
        total += one[:, i] * other[:, i]
    return total


def _squares(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (one * one).sum(axis=1)[:, None] + (other * other).sum(axis=1)[None, :] - 2.0 * (one @ other.T)


def k_means(rows: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Centroids of ``rows`` by Lloyd's rounds from evenly spaced rows; empty ones keep their place."""
    centroids = rows[np.linspace(0, len(rows) - 1, lists).astype(int)].copy()
    for _ in range(rounds):
        nearest = nearest_lists(rows, centroids, 1)[:, 0]
        counts = np.bincount(nearest, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        centroids[counts > 0] = sums[counts > 0] / counts[counts > 0][:, None]
    return centroids


def nearest_lists(rows: np.ndarray, centroids: np.ndarray, probes: int) -> np.ndarray:
    """Numbers of the ``probes`` nearest centroids of each row, nearest first."""
    found = np.zeros((len(rows), probes), np.int64)
    step = max(1, (1 << 20) // max(len(centroids), 1))
    for start in range(0, len(rows), step):
        gaps = (centroids * centroids).sum(axis=1)[None, :] - 2.0 * (rows[start : start + step] @ centroids.T)
        found[start : start + step] = np.argsort(gaps, axis=1, kind="stable")[:, :probes]
    return found


@dataclass(frozen=True)
class Index:
    """The lists of vectors of one length: what all tasks need to know."""

    dim: int
    longest: float
    centroids: np.ndarray
    probes: int


def fit(sample: np.ndarray, rows: int, longest: float, nearest: int = NEAREST) -> Index:
    """Centroids for ``rows`` vectors, and the probes that hold ``COVERED`` of the sample's neighbours.

    A sample is sparser than the table, so its neighbours are farther off and spread over
    more lists than those that will be asked for.
    """
    dim = sample.shape[1]
    whole = extended(sample, longest)
    lists = max(1, min(MOST_LISTS, round(rows / LIST_ROWS), len(sample) // 8))
    centroids = k_means(whole, lists)
    asked = np.arange(len(sample))[:: max(1, len(sample) // FIT_QUERIES)]
    queries = sample[asked]
    products = queries @ sample.T
    products[np.arange(len(asked)), asked] = -np.inf
    found = np.argsort(-products, axis=1, kind="stable")[:, : min(nearest, len(sample) - 1)]
    home = nearest_lists(whole, centroids, 1)[:, 0]
    order = nearest_lists(extended(queries, None), centroids, lists)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(lists)[None, :], axis=1)
    ranks = np.sort(np.take_along_axis(rank, home[found], axis=1).ravel())
    probes = 1 if len(ranks) == 0 else int(ranks[min(len(ranks) - 1, int(np.ceil(COVERED * len(ranks))) - 1)]) + 1
    return Index(dim, longest, centroids, probes)


def scan(
    queries: np.ndarray, rows: np.ndarray, bounds: np.ndarray, ids: np.ndarray, longest: float, nearest: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, row number and score of up to ``nearest`` rows of the list for each query.

    ``bounds`` are scores that ``nearest`` rows elsewhere are known to reach (minus infinity:
    none), below which a row need not be told. Equal scores go to the smaller of ``ids``.
    """
    dim = queries.shape[1] + 1
    turn = rotation(dim)
    q, x = extended(queries, None) @ turn, extended(rows, longest) @ turn
    bounds = bounds.copy()
    far = (queries * queries).sum(axis=1) + longest**2
    cuts = [*range(BLOCK, dim, BLOCK), dim]
    empty = np.zeros(0, np.int64)
    best_q, best_x, best_s = empty, empty, np.zeros(0)
    width = max(64, (1 << 21) // max(len(queries), 1))
    start = 0
    while start < len(rows):
        # A query without a bound scans a few rows to get one before the rest.
        step = min(width, 4 * nearest) if start == 0 and np.isneginf(bounds).any() else width
        part = x[start : start + step]
        limit = far - 2.0 * bounds
        limit += SLACK * (1.0 + np.where(np.isinf(limit), 0.0, np.abs(limit)))
        total = np.zeros((len(q), len(part)))
        alive, before = None, 0
        for cut in cuts:
            allowed = limit * (cut / dim) * ((1 + EPSILON / np.sqrt(cut)) ** 2 if cut < dim else 1.0)
            if alive is None:
                total += _squares(q[:, before:cut], part[:, before:cut])
                near = total <= allowed[:, None]
                if cut == dim or np.count_nonzero(near) * 8 < near.size:
                    i, j = np.nonzero(near)
                    alive = total[i, j]
            else:
                gap = q[i, before:cut] - part[j, before:cut]
                alive += np.einsum("ij,ij->i", gap, gap)
                near = alive <= allowed[i]
                i, j, alive = i[near], j[near], alive[near]
            before = cut
        score = inner_products(queries[i], rows[start + j]) if len(i) else np.zeros(0)
        best_q, best_x = np.r_[best_q, i], np.r_[best_x, start + j]
        best_s = np.r_[best_s, score]
        order = np.lexsort((ids[best_x], -best_s, best_q))
        best_q, best_x, best_s = best_q[order], best_x[order], best_s[order]
        first = np.searchsorted(best_q, best_q)
        place = np.arange(len(best_q)) - first
        kept = place < nearest
        best_q, best_x, best_s, place = best_q[kept], best_x[kept], best_s[kept], place[kept]
        last = place == nearest - 1
        bounds[best_q[last]] = np.maximum(bounds[best_q[last]], best_s[last])
        start += step
    return best_q, best_x, best_s


def _assigned(indexes: dict[int, Index], probing: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each row with its list, or (``probing``) once for each list that it probes, and their rank."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                index = indexes[int(dim)]
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                values = matrix(part.column("embedding"), index.dim)
                probes = index.probes if probing else 1
                found = nearest_lists(extended(values, None if probing else index.longest), index.centroids, probes)
                for rank in range(probes):
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(found[:, rank], pa.int32()), pa.array(np.full(len(found), rank, np.int32))],
                        [*part.schema.names, "list", "rank"],
                    )

    return assign


#: A class of equal vectors is told by its smallest id and a hash: an id may occur with several vectors.
CLASS = ("least", "member")
FOUND = "query long, least long, member long, score double"


def _scanned(asked: DataFrame, listed: DataFrame, indexes: dict[int, Index], nearest: int) -> DataFrame:
    """``FOUND``: for each of ``asked`` (query, dim, list, embedding, bound) what its list has for it.

    Both sides of a list are cut into tiles of bounded size, and each tile of queries meets
    each tile of rows in a task's turn.
    """
    cell = ["dim", "list"]
    rows_a_tile = F.greatest(F.lit(64), (F.lit(TILE_DOUBLES) / F.col("dim")).cast("int"))
    queries = asked.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) * 2 / F.first(rows_a_tile)).cast("int").alias("guests"))
    members = listed.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / F.first(rows_a_tile)).cast("int").alias("homes"))
    # A row for each list: MOST_LISTS at most for each length of vectors.
    met = F.broadcast(queries.join(members, cell))
    mine = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(met, cell).select(
        *cell, "query", "embedding", "bound", mine("query", "guests").alias("guest"), each("homes").alias("home")
    )
    right = listed.join(met, cell).select(
        *cell, *CLASS, "embedding", mine("member", "homes").alias("home"), each("guests").alias("guest")
    )

    def meet(asking: pa.Table, having: pa.Table) -> pa.Table:
        names = ["query", *CLASS, "score"]
        if asking.num_rows == 0 or having.num_rows == 0:
            return pa.table([*[pa.array([], pa.int64())] * 3, pa.array([], pa.float64())], names)
        index = indexes[asking.column("dim")[0].as_py()]
        least, member = (having.column(name).to_numpy() for name in CLASS)
        i, j, score = scan(
            matrix(asking.column("embedding"), index.dim), matrix(having.column("embedding"), index.dim),
            asking.column("bound").to_numpy(), least, index.longest, nearest,
        )
        return pa.table([asking.column("query").to_numpy()[i], least[j], member[j], score], names)

    keys = [*cell, "home", "guest"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, FOUND)


def _best(found: DataFrame, nearest: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), *CLASS)
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= nearest)


def _usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _sample(classes: DataFrame, dim: int, rows: int) -> np.ndarray:
    """Vectors of smallest hash, at most ``FIT_BYTES`` of them."""
    most = max(256, FIT_BYTES // (8 * dim))
    share = min(1.0, 1.1 * most / rows)
    drawn = classes.where(F.col("dim") == dim).withColumn("__draw", F.xxhash64(F.lit(7), "member"))
    drawn = drawn.where(F.pmod("__draw", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    table = drawn.orderBy("__draw").limit(most).select("embedding").toArrow()
    return matrix(table.column("embedding"), dim)


def nearest_vectors(vectors: DataFrame, every: int = EVERY, nearest: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows found for each vector whose id ``every`` divides.

    ``vectors`` has ``vec_id`` and ``embedding``. All rows but those of the query's own id are
    candidates. Nearest first, by the inner product of the original vectors as doubles; ties go
    to the smaller vec_id. A query has fewer than ``nearest`` answers where there are fewer
    candidates. Vectors that are null, empty or zero, or hold null, NaN or infinite entries, and
    rows without a vec_id, take no part; vectors of different lengths do not meet. A row
    that occurs several times is found several times; a vec_id that occurs with several
    vectors asks with the smallest of them. Other columns are ignored; an empty table
    gives no rows.

    Every row is listed and every probed list scanned whole. Centroids and the number of probes
    are fitted on a sample of ``FIT_BYTES``. Equal vectors are one class, listed once with as
    many of its smallest ids as an answer can hold, which loses nothing. What is approximate is
    that lists beyond the probed ones are not scanned, and that a test may err.
    """
    spark = vectors.sparkSession
    stage = Stage(spark, "nearest")
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & _usable(F.col("embedding"))
    )
    digest = [F.xxhash64("embedding").alias("d1"), F.xxhash64(F.lit(1), "embedding").alias("d2")]
    keyed = plain.select("vec_id", F.size("embedding").alias("dim"), "embedding", *digest)
    asking = keyed.where(F.pmod("vec_id", F.lit(every)) == 0)
    asked = stage.put(
        asking.groupBy("vec_id").agg(F.min(F.struct("embedding", "d1", "d2")).alias("q"), F.count(F.lit(1)).alias("rows")).select(
            "vec_id", "rows", "q.d1", "q.d2", "q.embedding"
        ),
        "asked",
    )
    # The rows of a query's own id, which are not told, are among the nearest: one, if ids do not repeat.
    most = nearest + (asked.agg(F.max("rows")).first()[0] or 1)
    # Spark takes the smallest ids of a class in each task before it moves rows.
    small = keyed.withColumn("n", F.row_number().over(Window.partitionBy("d1", "d2").orderBy("vec_id"))).where(F.col("n") <= most)
    classes = stage.put(
        small.groupBy("d1", "d2").agg(
            F.min("vec_id").alias("least"), F.first("d1").alias("member"), F.first("dim").alias("dim"), F.first("embedding").alias("embedding"),
            F.sort_array(F.collect_list("vec_id")).alias("ids"),
        ),
        "classes",
    )
    queries = stage.put(
        asked.groupBy("d1", "d2").agg(F.min("vec_id").alias("query"), F.first("embedding").alias("embedding")).select(
            "query", "d1", "d2", F.size("embedding").alias("dim"), "embedding"
        ),
        "queries",
    )
    squares = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sizes = classes.groupBy("dim").agg(F.count(F.lit(1)).alias("rows"), F.max(squares).alias("most")).collect()
    indexes = {
        row["dim"]: fit(_sample(classes, row["dim"], row["rows"]), row["rows"], float(np.sqrt(row["most"])), nearest)
        for row in sizes
    }
    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    place = f"dim int, embedding {kinds['embedding']}, list int, rank int"
    listed = stage.put(
        classes.select(*CLASS, "dim", "embedding").mapInArrow(_assigned(indexes, False), f"least long, member long, {place}").drop("rank"), "listed"
    )
    probed = stage.put(
        queries.select("query", "dim", "embedding").mapInArrow(_assigned(indexes, True), f"query long, {place}"), "probed"
    )
    unbound = F.lit(float("-inf")).alias("bound")
    columns = ["query", "dim", "list", "embedding"]
    home = stage.put(_scanned(probed.where("rank = 0").select(*columns, unbound), listed, indexes, most), "home")
    bounds = _best(home, most).where(F.col("place") == most).select("query", F.col("score").alias("bound"))
    bounds = stage.put(bounds, "bounds")
    others = probed.where("rank > 0").join(small_or_not(bounds), "query", "left")
    others = others.select(*columns, F.coalesce("bound", F.lit(float("-inf"))).alias("bound"))
    found = stage.put(home.unionByName(_scanned(others, listed, indexes, most)), "found")

    best = _best(found, most).join(classes.select(*CLASS, "ids"), [*CLASS])
    answers = best.groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("found"))
    rows = F.flatten(F.transform("found", lambda f: F.transform(f["ids"], lambda i: F.struct((-f["score"]).alias("s"), i.alias("i")))))
    answers = stage.put(answers.select("query", F.slice(F.array_sort(rows), 1, most).alias("rows")), "answers")
    of = asked.select(F.col("vec_id").alias("query_id"), "d1", "d2").join(queries.select("query", "d1", "d2"), ["d1", "d2"])
    told = of.join(answers, "query").select(
        "query_id", F.slice(F.filter("rows", lambda r: r["i"] != F.col("query_id")), 1, nearest).alias("rows")
    )
    return told.select("query_id", F.posexplode("rows").alias("at", "row")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("row.i").alias("vec_id"), (-F.col("row.s")).alias("score")
    )
