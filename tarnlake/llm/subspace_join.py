"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors at cosine c are at squared distance 2 - 2c. After a rotation they are cut into
blocks of few dimensions. If the whole squared distance is within the budget, some block's
is within the share of the budget that its dimensions make up, so joining every block by
range and taking the union finds every pair; the full vectors then decide.

The range join of a block: its first coordinates give a cell of a grid whose side is the
block's radius, and rows meet those of their own and the next cells. Cells of many rows are
cut into tiles, and each pair of tiles is a bounded matrix product. A tile pair reports
links per row and a spanning forest, never its pairs.
"""

from __future__ import annotations

from itertools import product
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.components import components
from tarnlake.llm.staging import Stage

BLOCKS = 8
#: Rows of a tile; a pair of tiles compares at most about TILE * TILE vectors.
TILE = 2048
#: Slack on block budgets, far above rounding and far below any distance that matters.
SLACK = 1e-9


def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation, so that no block holds most of the spread of the data."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def blocks_of(dim: int, blocks: int = BLOCKS) -> list[slice]:
    edges = np.linspace(0, dim, min(blocks, dim) + 1).round().astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def budget(cosine: float, dim: int, part: slice) -> float:
    return (2.0 - 2.0 * cosine) * (part.stop - part.start) / dim + SLACK


def _offsets(depth: int) -> list[tuple[int, ...]]:
    """The own cell and one of each two opposite neighbours."""
    return [o for o in product((-1, 0, 1), repeat=depth) if o >= (0,) * depth]


def _cells(batches, cosine: float, depth: int):
    """Each vector once per block as a member of its cell, and as a visitor of cells around."""
    names = ["vec_id", "label", "dim", "copies", "embedding", "block", "cell", "visitor", "own"]
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            part = batch.take(pa.array(rows))
            turned = unit_vectors(matrix(part.column("embedding"), int(dim))) @ rotation(int(dim))
            fixed = [part.column(name) for name in names[:5]]
            for number, block in enumerate(blocks_of(int(dim))):
                axes = turned[:, block.start : min(block.stop, block.start + depth)]
                cell = np.floor(axes / np.sqrt(budget(cosine, int(dim), block))).astype(np.int64)
                for visitor, offset in [(False, (0,) * depth), *((True, o) for o in _offsets(depth))]:
                    moved = cell + np.asarray(offset[: cell.shape[1]])
                    if any(offset[cell.shape[1] :]):
                        continue
                    key = pa.ListArray.from_arrays(
                        np.arange(len(rows) + 1, dtype=np.int32) * cell.shape[1], moved.ravel()
                    )
                    n = len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [*fixed, pa.array(np.full(n, number, np.int32)), key,
                         pa.array(np.full(n, visitor)), pa.array(np.full(n, not any(offset)))],
                        names,
                    )


def _find(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _tile_links(table: pa.Table, cosine: float) -> pa.Table:
    """Links between the members and the visitors of one pair of tiles."""
    table = table.combine_chunks()
    visitor = table.column("visitor").to_numpy()
    dim, number = table.column("dim")[0].as_py(), table.column("block")[0].as_py()
    ids, copies = table.column("vec_id").to_numpy(), table.column("copies").to_numpy()
    own = table.column("own").to_numpy()
    unit = unit_vectors(matrix(table.column("embedding"), dim))
    turned = unit @ rotation(dim)
    parts = blocks_of(dim)
    limits = [budget(cosine, dim, part) for part in parts]
    home, guest = np.flatnonzero(~visitor), np.flatnonzero(visitor)
    links = np.zeros(len(ids), np.int64)
    parent = np.arange(len(ids))
    place = {}
    same = np.asarray([place.setdefault(int(v), i) for i, v in enumerate(ids)])
    here = turned[:, parts[number]]
    squares = (here * here).sum(axis=1)
    for start in range(0, len(home), 512):
        rows = home[start : start + 512]
        distance = squares[rows][:, None] + squares[guest][None, :] - 2.0 * (here[rows] @ here[guest].T)
        near = (distance <= limits[number]) & (~own[guest][None, :] | (ids[rows][:, None] < ids[guest][None, :]))
        i, j = np.nonzero(near)
        for at in range(0, len(i), 100_000):
            a, b = rows[i[at : at + 100_000]], guest[j[at : at + 100_000]]
            linked = np.einsum("ij,ij->i", unit[a], unit[b]) >= cosine
            a, b = a[linked], b[linked]
            for earlier in range(number):  # a pair counts in the first block that finds it
                gap = turned[a][:, parts[earlier]] - turned[b][:, parts[earlier]]
                first = (gap * gap).sum(axis=1) > limits[earlier] - SLACK / 2
                a, b = a[first], b[first]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            for x, y in zip(same[a].tolist(), same[b].tolist(), strict=True):
                x, y = _find(parent, x), _find(parent, y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
    roots = np.asarray([_find(parent, int(i)) for i in same])
    told = np.flatnonzero((links > 0) | (ids[roots] != ids))
    return pa.table({"a": ids[told], "links": links[told], "b": ids[roots[told]]})


def near_vectors(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``.

    Vectors (``vec_id``, ``embedding``, ``label``) are compared where labels are equal and
    lengths too. A null, empty or zero vector, one with a null, NaN or infinite component, and
    one without a label or id links with nothing and stands alone. Equal vectors of a label
    are one class, which is joined once. Other columns are ignored; an empty table gives an
    empty result.
    """
    stage = Stage(vectors.sparkSession, "vectors")
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    top = F.lit(float("inf"))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < top))
    nonzero = F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound & nonzero, F.lit(False))
    digest = F.struct(F.xxhash64("embedding"), F.xxhash64(F.lit(1), "embedding"))
    keyed = plain.withColumn("usable", usable).withColumn("digest", digest)
    classes = stage.put(
        keyed.where("usable")
        .groupBy("label", "digest")
        .agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"), F.min("embedding").alias("embedding"))
        .select("vec_id", "label", F.size("embedding").alias("dim"), "copies", "embedding", "digest"),
        "classes",
    )
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    depth = max(1, min(3, round(log(max(most / TILE, 1)) / log(3))))
    fields = {f.name: f.dataType.simpleString() for f in classes.schema}
    schema = (
        f"vec_id long, label {fields['label']}, dim int, copies long, embedding {fields['embedding']}, "
        "block int, cell array<long>, visitor boolean, own boolean"
    )
    placed = classes.drop("digest").mapInArrow(lambda batches: _cells(batches, cosine, depth), schema)
    cell = ["label", "dim", "block", "cell"]
    tiles = lambda who: F.ceil(F.count(F.when(who, 1)) / TILE).cast("int")
    met = (
        placed.groupBy(*cell)
        .agg(tiles(~F.col("visitor")).alias("homes"), tiles(F.col("visitor")).alias("guests"))
        .where("homes > 0 and guests > 0")
    )
    mine = F.pmod(F.xxhash64("vec_id"), F.when(F.col("visitor"), F.col("guests")).otherwise(F.col("homes")))
    others = F.explode(F.sequence(F.lit(0), F.when(F.col("visitor"), F.col("homes")).otherwise(F.col("guests")) - 1))
    dealt = placed.join(met, cell).withColumn("mine", mine.cast("int")).withColumn("other", others)
    home = F.when(F.col("visitor"), F.col("other")).otherwise(F.col("mine"))
    guest = F.when(F.col("visitor"), F.col("mine")).otherwise(F.col("other"))
    tiled = dealt.withColumn("home", home).withColumn("guest", guest).drop("homes", "guests", "mine", "other")
    found = stage.put(
        tiled.groupBy(*cell, "home", "guest").applyInArrow(
            lambda table: _tile_links(table, cosine), "a long, links long, b long"
        ),
        "links",
    )
    counts = found.groupBy(F.col("a").alias("vec_id")).agg(F.sum("links").alias("links"))
    component = components(found.select("a", "b"), stage).withColumnRenamed("node", "vec_id")
    of_class = (
        classes.select("label", "digest", "vec_id", "copies")
        .join(counts, "vec_id", "left")
        .join(component, "vec_id", "left")
        .select(
            "label", "digest",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
    )
    together = keyed.where("usable").select("vec_id", "label", "digest").join(of_class, ["label", "digest"])
    alone = keyed.where("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    result = together.select("vec_id", "n_links", "component_id").unionByName(alone)
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
