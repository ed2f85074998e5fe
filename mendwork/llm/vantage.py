"""Nearest neighbours with one vantage-point tree per shard.

A tree node picks a vantage point, sorts its points by distance to it and gives each half the range of these
distances. By the triangle inequality a half can hold a neighbour closer than the k-th best so far (tau)
only if its range meets [d - tau, d + tau]. ``factor`` relaxes that to tau / factor: larger factors prune
more and may miss neighbours; 1 is exact.

Shards are cut by the same inequality: each vector belongs to the cell of its nearest pivot, a large cell is cut
into rings of the distance to the pivot, and a ring of too many vectors (copies) is dealt by a hash. A query first
searches the shard it lies in; with the tau it finds there it visits only the shards that may hold something closer.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendwork.session import materialise

from . import common
from .common import SLICE, arrow_schema, bounded_sample
from .hard_negatives import k_means, matrix

common.ship(__name__)

K = 10
FACTOR = 1.0
SHARD_VECTORS = 8192
QUERY_BLOCK = 4096
LEAF = 64
# Pivots come from a hash sample of about so many vectors: they change the work only, never the answers at factor 1.
PIVOT_SAMPLE = 8192
MOST_PIVOTS = 1024
RINGS = 64
# Room for rounding when two distances are compared with a third.
SLACK = 1e-9

SHARD = ["dim", "cell", "ring", "part"]


def build_tree(points: np.ndarray, leaf: int = LEAF, seed: int = 6) -> dict[str, np.ndarray]:
    """A tree over the rows of ``points``: an order of the rows and nodes as ranges of it.

    Halves are cut by position, so equal vectors do not make a tree deep.
    """
    rng = np.random.default_rng(seed)
    order = np.arange(len(points))
    nodes: list[list[float]] = []

    def grow(begin: int, end: int) -> int:
        number = len(nodes)
        nodes.append([begin, end, -1, -1, 0, 0, 0, 0])
        if end - begin > leaf:
            pick = begin + int(rng.integers(end - begin))
            order[[begin, pick]] = order[[pick, begin]]
            rest = order[begin + 1 : end]
            far = np.sqrt(((points[rest] - points[order[begin]]) ** 2).sum(axis=1))
            by = np.argsort(far, kind="stable")
            order[begin + 1 : end], far = rest[by], far[by]
            half = len(far) // 2
            nodes[number][4:] = [far[0], far[half - 1], far[half], far[-1]]
            nodes[number][2] = grow(begin + 1, begin + 1 + half)
            nodes[number][3] = grow(begin + 1 + half, end)
        return number

    if len(points):
        grow(0, len(points))
    return {"order": order, "nodes": np.array(nodes, dtype=np.float64).reshape(-1, 8)}


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``left`` to all of ``right``, added up component by component."""
    if len(left) * len(right) <= 1 << 11:
        # The same sums in the same order, with few calls for few pairs.
        squares = (left[:, None, :] - right[None, :, :]) ** 2
        return np.sqrt(np.cumsum(squares, axis=2)[:, :, -1])
    total = np.zeros((len(left), len(right)))
    for i in range(left.shape[1]):
        total += (left[:, i, None] - right[None, :, i]) ** 2
    return np.sqrt(total)


def reach_of(tau: np.ndarray, far: np.ndarray, factor: float) -> np.ndarray:
    """How far from the query something may lie to be looked at, with room for the rounding of ``far``."""
    return tau / factor * (1 + SLACK) + SLACK * (1 + far)


def search_tree(
    tree: dict[str, np.ndarray],
    points: np.ndarray,
    ids: np.ndarray,
    queries: np.ndarray,
    query_ids: np.ndarray,
    k: int,
    factor: float,
    tau: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ids and distances of the k nearest rows, nearest first, ties to the smaller id.

    A row with the query's own id is left out. Unused places have the distance infinity. Rows farther away than
    the query's ``tau`` need not be found.
    """
    tau = np.full(len(queries), np.inf) if tau is None else tau
    order, nodes = tree["order"], tree["nodes"]
    best = np.full((len(queries), k), np.inf)
    found = np.full((len(queries), k), np.iinfo(np.int64).max)

    def offer(active: np.ndarray, rows: np.ndarray) -> np.ndarray:
        far = distances(queries[active], points[rows])
        names = np.broadcast_to(ids[rows], far.shape)
        own = names == query_ids[active][:, None]
        # Only queries that gain something sort again.
        gains = (far <= np.minimum(best[active, -1], tau[active])[:, None]).any(axis=1)
        some = active[gains]
        all_far = np.concatenate([best[some], np.where(own, np.inf, far)[gains]], axis=1)
        all_ids = np.concatenate([found[some], np.where(own, np.iinfo(np.int64).max, names)[gains]], axis=1)
        by = np.lexsort((all_ids, all_far), axis=1)[:, :k]
        best[some] = np.take_along_axis(all_far, by, axis=1)
        found[some] = np.take_along_axis(all_ids, by, axis=1)
        return far

    def visit(number: int, active: np.ndarray) -> None:
        if not len(active):
            return
        begin, end, left, right, *edges = nodes[number].tolist()
        if left < 0:
            offer(active, order[int(begin) : int(end)])
            return
        far = offer(active, order[int(begin) : int(begin) + 1])[:, 0]
        closer = far <= (edges[1] + edges[2]) / 2
        for first in (True, False):
            for child, low, high, mine in ((left, edges[0], edges[1], closer), (right, edges[2], edges[3], ~closer)):
                turn = mine if first else ~mine
                reach = reach_of(np.minimum(best[active, -1], tau[active]), far, factor)
                visit(int(child), active[turn & (far - reach <= high) & (far + reach >= low)])

    if len(nodes):
        visit(0, np.arange(len(queries)))
    return found, best


def _pack(**arrays: np.ndarray) -> bytes:
    buffer = io.BytesIO()
    np.savez(buffer, **arrays)
    return buffer.getvalue()


def valid_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, vector as doubles): without nulls, zero vectors and vectors with a null or non-finite component.

    Rows that repeat an id count once; of different vectors the smallest in array order counts.
    """
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    # A null component makes forall null or false; either way the row goes.
    rows = rows.where("vec_id is not null and size(vector) > 0").where(finite).where(F.exists("vector", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


@dataclass
class Index:
    """Pivots by dimension, the rings of their cells (dim, cell, ring, parts, lo, hi), and a tree per shard."""

    pivots: dict[int, np.ndarray]
    rings: DataFrame
    trees: DataFrame


def choose_pivots(vectors: DataFrame, shard_vectors: int, sample: int = PIVOT_SAMPLE, most: int = MOST_PIVOTS) -> dict[int, np.ndarray]:
    """About two pivots per shard's worth of vectors, ``most`` at most in all dimensions together.

    A dimension that the sample lacks has none: its vectors are one cell, which is searched all the same.
    """
    total = vectors.count()
    some = bounded_sample(vectors.select("vec_id", "vector"), "vec_id", sample).toArrow()
    sizes = np.array([len(v) for v in some.column("vector")], dtype=np.int64)
    pivots, left = {}, most
    dims, rows = np.unique(sizes, return_counts=True)
    for dim, n in sorted(zip(dims.tolist(), rows.tolist(), strict=True), key=lambda x: (-x[1], x[0])):
        wanted = min(left, max(1, round(2 * total * n / len(sizes) / shard_vectors)))
        if wanted:
            own = some.take(pa.array(np.nonzero(sizes == dim)[0]))
            pivots[dim] = k_means(matrix(own.column("vector"), dim), wanted, 6)
            left -= len(pivots[dim])
    return pivots


def to_pivots(vector: pa.Array, pivots: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, places of rows, their distances to the dimension's pivots), a bounded number of rows at a time.

    Without pivots there is one column of zeros.
    """
    sizes = np.asarray(pc.list_value_length(vector).to_numpy(zero_copy_only=False), dtype=np.int64)
    for dim in np.unique(sizes).tolist():
        places = np.nonzero(sizes == dim)[0]
        for start in range(0, len(places), SLICE):
            some = places[start : start + SLICE]
            if dim in pivots:
                yield dim, some, distances(matrix(vector.take(pa.array(some)), dim), pivots[dim])
            else:
                yield dim, some, np.zeros((len(some), 1))


def assign(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """(vec_id, vector, dim, cell, far): each vector's nearest pivot and the distance to it."""
    schema = "vec_id long, vector array<double>, dim int, cell int, far double"
    target = arrow_schema(vectors, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, places, far in to_pivots(batch.column(1), pivots):
                rows = batch.take(pa.array(places))
                made = [np.full(len(places), dim), far.argmin(axis=1), far.min(axis=1)]
                arrays = [rows.column(0), rows.column(1), *(pa.array(m) for m in made)]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, target, strict=True)], schema=target)

    return vectors.select("vec_id", "vector").mapInArrow(run, schema)


def build_index(vectors: DataFrame, shard_vectors: int = SHARD_VECTORS, leaf: int = LEAF, sample: int = PIVOT_SAMPLE) -> Index:
    """An index of all rows of (vec_id, vector); a shard has about ``shard_vectors`` rows at most, whatever they hold."""
    pivots = choose_pivots(vectors, shard_vectors, sample)
    placed = materialise(assign(vectors, pivots), "cells")
    quantiles = F.percentile_approx("far", [i / RINGS for i in range(1, RINGS)], 1000)
    cells = placed.groupBy("dim", "cell").agg(quantiles.alias("edges"), F.least(F.ceil(F.count("*") / shard_vectors), F.lit(RINGS)).alias("cuts"))
    below = F.size(F.filter("edges", lambda e: e < F.col("far")))
    ringed = placed.join(materialise(cells, "cell-edges"), ["dim", "cell"]).withColumn("ring", F.floor(below * F.col("cuts") / RINGS).cast("int"))
    ringed = ringed.drop("edges", "cuts")
    rings = ringed.groupBy("dim", "cell", "ring").agg(
        F.ceil(F.count("*") / shard_vectors).alias("parts"), F.min("far").alias("lo"), F.max("far").alias("hi")
    )
    rings = materialise(rings, "rings")

    def build(key, table):
        ids = table.column("vec_id").to_numpy()
        points = matrix(table.column("vector"), key[0].as_py())
        by = np.argsort(ids)
        ids, points = ids[by], points[by]
        tree = _pack(ids=ids, points=points, **build_tree(points, leaf))
        return pa.table({**{n: pa.array([k.as_py()], k.type) for n, k in zip(SHARD, key, strict=True)}, "tree": pa.array([tree], pa.binary())})

    keyed = ringed.join(rings.select("dim", "cell", "ring", "parts"), ["dim", "cell", "ring"])
    keyed = keyed.select("vec_id", "vector", "dim", "cell", "ring", _part("vec_id").alias("part"))
    trees = keyed.groupBy(*SHARD).applyInArrow(build, "dim int, cell int, ring int, part long, tree binary")
    return Index(pivots, rings, materialise(trees, "trees"))


def _part(id_column: str) -> Column:
    return F.pmod(F.xxhash64(id_column), F.col("parts"))


def visit(index: Index, visits: DataFrame, queries: DataFrame, k: int, factor: float, query_block: int) -> DataFrame:
    """(query_id, vec_id, score): what the queries find in the shards that they visit.

    ``visits`` has (query_id, shard, tau), ``queries`` (query_id, vector). A shard's tree is copied once per
    block of its visitors, so a shard that many queries visit is searched by several tasks.
    """
    counted = visits.groupBy(*SHARD).agg(F.ceil(F.count("*") / query_block).cast("int").alias("blocks"))
    counted = materialise(counted, "visited")
    block = F.pmod(F.xxhash64("query_id", F.lit(7)), F.col("blocks")).cast("int").alias("block")
    asked = visits.join(counted, SHARD).select("query_id", "tau", *SHARD, block).join(queries, "query_id")
    trees = index.trees.join(counted, SHARD).select(*SHARD, "tree", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def answer(left, right):
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            ids = left.column("query_id").to_numpy()
            tau = left.column("tau").to_numpy()
            tree = dict(np.load(io.BytesIO(right.column("tree")[0].as_py())))
            points = matrix(left.column("vector"), tree["points"].shape[1])
            found, best = search_tree(tree, tree["points"], tree["ids"], points, ids, k, factor, tau)
            rows, places = np.nonzero(np.isfinite(best) & (best <= tau[:, None]))
            out = {"query_id": ids[rows], "vec_id": found[rows, places], "score": best[rows, places]}
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()), "score": pa.array(out["score"], pa.float64())})

    keys = [*SHARD, "block"]
    return asked.groupBy(*keys).cogroup(trees.groupBy(*keys)).applyInArrow(answer, "query_id long, vec_id long, score double")


def home_shards(index: Index, queries: DataFrame) -> DataFrame:
    """(query_id, shard): the ring of the nearest pivot's cell that a query lies in or next to, one part of it."""
    placed = assign(queries, index.pivots).withColumnRenamed("vec_id", "query_id")
    gap = F.greatest(F.col("lo") - F.col("far"), F.col("far") - F.col("hi"), F.lit(0.0))
    nearest = F.min_by(F.struct("dim", "cell", "ring", "parts"), F.struct(gap, "ring")).alias("home")
    homes = placed.drop("vector").join(index.rings, ["dim", "cell"]).groupBy("query_id").agg(nearest)
    return homes.select("query_id", "home.*").select("query_id", "dim", "cell", "ring", _part("query_id").alias("part"))


def other_shards(index: Index, queries: DataFrame, factor: float = FACTOR) -> DataFrame:
    """(query_id, shard, tau): all shards that may hold something closer than the query's ``tau``.

    Cells are left out by their distances to the pivot and by the pivot that is nearest (a vector of a cell is at
    least half the difference of the query's two distances away), then rings by their own distances.
    """
    schema = "query_id long, tau double, dim int, cell int, far double, reach double"
    target = arrow_schema(queries, schema)
    pivots = index.pivots
    # One row per pivot, so bounded.
    ranges = {(r.dim, r.cell): (r.lo, r.hi) for r in index.rings.groupBy("dim", "cell").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where(
        F.col("dim").isin(list(pivots))
    ).collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, taus = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for dim, places, far in to_pivots(batch.column(1), pivots):
                # A cell without vectors has no range and is never reached.
                span = np.array([ranges.get((dim, c), (0.0, 0.0) if dim not in pivots else (np.inf, -np.inf)) for c in range(far.shape[1])])
                tau = taus[places]
                reach = reach_of(tau[:, None], far, factor)
                out_of = (far - reach > span[:, 1]) | (far + reach < span[:, 0]) | ((far - far.min(axis=1, keepdims=True)) / 2 > reach)
                rows, cells = np.nonzero(~out_of & ~np.isinf(span[:, 0]))
                arrays = [ids[places][rows], tau[rows], np.full(len(rows), dim), cells, far[rows, cells], reach[rows, cells]]
                yield pa.RecordBatch.from_arrays([pa.array(a).cast(f.type) for a, f in zip(arrays, target, strict=True)], schema=target)

    cells = queries.select("query_id", "vector", "tau").mapInArrow(run, schema)
    meets = (F.col("far") - F.col("reach") <= F.col("hi")) & (F.col("far") + F.col("reach") >= F.col("lo"))
    rings = cells.join(index.rings, ["dim", "cell"]).where(meets)
    return rings.select("query_id", "tau", "dim", "cell", "ring", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))


def search(index: Index, queries: DataFrame, k: int = K, factor: float = FACTOR, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each query by Euclidean distance, ranks from 1.

    ``queries`` has (vec_id, vector). Vectors of another dimension are no candidates. The answers of the shard that
    a query lies in bound what the other shards have to find; they are merged by query.
    """
    asked = queries.select(F.col("vec_id").alias("query_id"), "vector")
    homes = materialise(home_shards(index, queries), "home-shards")
    first = materialise(visit(index, homes.withColumn("tau", F.lit(float("inf"))), asked, k, factor, query_block), "home-answers")
    full = first.groupBy("query_id").agg(F.max("score").alias("tau"), F.count("*").alias("n")).where(F.col("n") >= k)
    bounded = asked.join(full.drop("n"), "query_id", "left").select("query_id", "vector", F.coalesce("tau", F.lit(float("inf"))).alias("tau"))
    rest = materialise(other_shards(index, bounded, factor).join(homes, ["query_id", *SHARD], "left_anti"), "other-shards")
    answers = first.union(visit(index, rest, asked, k, factor, query_block))
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return answers.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(
    vectors: DataFrame,
    every: int = 100,
    k: int = K,
    factor: float = FACTOR,
    shard_vectors: int = SHARD_VECTORS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Search the table for the rows whose id is divisible by ``every``; see ``search``.

    Rows without an id or a valid vector take no part; an empty table gives no rows; with fewer than k
    candidates all are returned. Other columns are ignored.
    """
    points = materialise(valid_vectors(vectors, id_column, vector_column), "vectors")
    index = build_index(points, shard_vectors)
    return search(index, points.where(F.pmod("vec_id", F.lit(every)) == 0), k, factor)
