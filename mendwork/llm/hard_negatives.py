"""Hard negatives by an inverted multi-index.

Vectors are cut into two halves, each with a codebook of its own (k-means on a bounded sample); the pairs of codes
are the cells, and every row lies in one. For an anchor, a half's score with any row of a code is at most the
score with the centre plus the anchor's length times the code's radius, the largest distance of any of its rows
from the centre. A heap visits the cells by the sum of both halves' bounds, largest first, until the bound of
what is left can't change the answer: the certificate that makes the search exact.

Codes are dealt into shards of bounded size (a code with very many rows into several), radii are taken by shard,
and blocks of anchors meet each shard in a task of their own. The first pass finds each anchor's positives, the
second one the rows in the windows below them; what a shard returns is bounded, and merged by anchor.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mendwork.session import materialise

from . import common
from .common import bounded_sample

common.ship(__name__)

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
# A negative's score is at least this share of the positive's, in per cent.
LOW_PERCENT = 80
# Codes of each half.
CODES = 16
# Rows at most, about, that the codebooks are fitted on.
SAMPLE = 20_000
SHARD_ROWS = 16_384
ANCHOR_BLOCK = 4_096
# Sums below it are exact as doubles.
EXACT = float(1 << 53)

INDEXED = "vec_id long, label int, vector array<double>, dim int, first int, second int"


def usable_rows(
    vectors: DataFrame, scale: int = SCALE, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> DataFrame:
    """(vec_id, label, vector): components become floor(scale * x).

    Without rows whose id, label or vector is null, whose vector is empty, or that have a null or non-finite
    component. Zero vectors take part. Rows that repeat an id count once: the smallest label, then the smallest vector.
    """
    raw = F.col(f"`{vector_column}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{label_column}`").cast("int").alias("label"), raw.alias("raw"))
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where("vec_id is not null and label is not null and size(raw) > 0").where(finite)
    # floor() of a double is a long in Spark; beyond that range every double is a whole number already.
    whole = F.transform("raw", lambda x: F.when(F.abs(x * scale) < 9e15, F.floor(x * scale).cast("double")).otherwise(x * scale))
    one = rows.select("vec_id", F.struct("label", whole.alias("vector")).alias("row")).groupBy("vec_id").agg(F.min("row").alias("row"))
    return one.select("vec_id", "row.label", "row.vector")


def k_means(points: np.ndarray, codes: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centres of at most ``codes`` groups (fewer points: each its own centre); no points give the zero vector."""
    if not len(points):
        return np.zeros((1, points.shape[1]))
    distinct = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centres = distinct[rng.permutation(len(distinct))[:codes]].copy()
    for _ in range(rounds):
        own = nearest_code(points, centres)
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = points[own == c].mean(axis=0)
    return centres


def nearest_code(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1)[None, :] - 2 * (points @ centres.T)).argmin(axis=1)


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Lists of ``dim`` doubles as rows."""
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def fit_codebooks(rows: DataFrame, codes: int = CODES, sample: int = SAMPLE, seed: int = 12) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Both halves' centres by dimension, from a hash sample of at most about ``sample`` rows.

    A dimension that the sample lacks has one code per half, the zero vector: its rows are found all the same.
    """
    some = bounded_sample(rows.select("vec_id", "vector"), "vec_id", sample).toArrow()
    sizes = np.array([len(v) for v in some.column("vector")], dtype=np.int64)
    books = {}
    for dim in np.unique(sizes).tolist():
        points = matrix(some.filter(pa.array(sizes == dim)).column("vector"), dim)
        half = dim // 2
        books[dim] = (k_means(points[:, :half], codes, seed), k_means(points[:, half:], codes, seed + 1))
    return books


def centres_of(books: dict[int, tuple[np.ndarray, np.ndarray]], dim: int) -> tuple[np.ndarray, np.ndarray]:
    return books.get(dim) or (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)))


def with_codes(rows: DataFrame, books: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Every row with its dimension and the codes of its halves."""
    target = common.arrow_schema(rows, INDEXED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            sizes = np.asarray(pc.list_value_length(vectors).to_numpy(zero_copy_only=False), dtype=np.int64)
            codes = np.zeros((2, len(sizes)), dtype=np.int32)
            for dim in np.unique(sizes).tolist():
                at = np.nonzero(sizes == dim)[0]
                points = matrix(vectors.take(pa.array(at)), dim)
                halves = (points[:, : dim // 2], points[:, dim // 2 :])
                for k, (half, centres) in enumerate(zip(halves, centres_of(books, dim), strict=True)):
                    codes[k, at] = nearest_code(half, centres)
            arrays = [*batch.columns, pa.array(sizes.astype(np.int32)), pa.array(codes[0]), pa.array(codes[1])]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, target, strict=True)], schema=target)

    return rows.select("vec_id", "label", "vector").mapInArrow(run, INDEXED)


def with_shards(coded: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """Every row with its shard, and the number of shards.

    Codes of the first half that follow each other share a shard until it is full; a code with more rows than
    that is dealt into several by a hash of the id. Only one row per dimension and code comes to the driver.
    """
    counted = coded.groupBy("dim", "first").agg(F.count("*").alias("n")).orderBy("dim", "first").collect()
    plan, shards, room, last = [], 0, 0, None
    for r in counted:
        if r.dim != last or r.n > room:
            split = -(-r.n // shard_rows)
            plan.append((r.dim, r.first, shards, split))
            shards, room, last = shards + split, (shard_rows - r.n if split == 1 else 0), r.dim
        else:
            plan.append((r.dim, r.first, shards - 1, 1))
            room -= r.n
    where = coded.sparkSession.createDataFrame(plan, "dim int, first int, shard_from int, split int")
    shard = F.col("shard_from") + F.pmod(F.xxhash64("vec_id"), F.col("split")).cast("int")
    return coded.join(F.broadcast(where), ["dim", "first"]).select(*coded.columns, shard.alias("shard")), shards


def by_bound(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """All pairs of places with the sum of their values, largest sum first (multi-sequence by a heap)."""
    a, b = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    x, y = first[a].tolist(), second[b].tolist()
    heap = [(-(x[0] + y[0]), 0, 0)] if a and b else []
    while heap:
        value, i, j = heapq.heappop(heap)
        yield a[i], b[j], -value
        # (i, j + 1) follows from (i, j) alone, and (i + 1, 0) from (i, 0): each pair enters once.
        if j + 1 < len(b):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))


class Cells:
    """One shard's rows by cell, with what bounds their scores."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray, codes: tuple[np.ndarray, np.ndarray], centres: tuple[np.ndarray, np.ndarray]):
        # The codes that occur here, renumbered.
        used, own = zip(*(np.unique(c, return_inverse=True) for c in codes), strict=True)
        order = np.lexsort((own[1], own[0]))
        self.ids, self.labels, self.points = ids[order], labels[order], points[order]
        cell = own[0][order] * len(used[1]) + own[1][order]
        self.edges = np.searchsorted(cell, np.arange(len(used[0]) * len(used[1]) + 1))
        self.width, self.half = len(used[1]), points.shape[1] // 2
        self.centres = tuple(c[u] for c, u in zip(centres, used, strict=True))
        self.radii = []
        for half, c, o in zip((points[:, : self.half], points[:, self.half :]), self.centres, own, strict=True):
            far = np.zeros(len(c))
            np.maximum.at(far, o, np.sqrt(((half - c[o]) ** 2).sum(axis=1)))
            self.radii.append(far)
        self.largest = np.abs(points).max(initial=0.0)

    def bounds(self, anchor: np.ndarray) -> list[np.ndarray]:
        """For every code of each half the most that any of its rows can score, with room for rounding."""
        out = []
        for half, c, far in zip((anchor[: self.half], anchor[self.half :]), self.centres, self.radii, strict=True):
            length = np.sqrt((half**2).sum())
            out.append(c @ half + length * far + 1e-9 * length * (far + np.sqrt((c**2).sum(axis=1))) + 1e-6)
        return out

    def scores(self, begin: int, end: int, anchor: np.ndarray) -> np.ndarray:
        """Whole-number inner products: as doubles while those are exact, else as Python's integers."""
        if self.largest * np.abs(anchor).sum() < EXACT:
            return (self.points[begin:end] @ anchor).astype(np.int64)
        whole = [int(x) for x in anchor]
        return np.array([sum(int(p) * w for p, w in zip(row, whole, strict=True)) for row in self.points[begin:end].tolist()], dtype=object)

    def visit(self, anchor: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """(bound, begin, end) of every cell that has rows, largest bound first."""
        for i, j, bound in by_bound(*self.bounds(anchor)):
            begin, end = self.edges[i * self.width + j : i * self.width + j + 2].tolist()
            if end > begin:
                yield bound, begin, end


def _first(scores: np.ndarray, ids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` highest scores, ties to the smaller id."""
    by = np.lexsort((ids, -scores))[:count]
    return scores[by], ids[by]


def best_alike(cells: Cells, anchor: np.ndarray, anchor_id: int, label: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` best other rows of the label; no unvisited row could be among them."""
    scores, ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for bound, begin, end in cells.visit(anchor):
        if len(scores) == count and scores[-1] > bound:
            break
        mine = np.nonzero((cells.labels[begin:end] == label) & (cells.ids[begin:end] != anchor_id))[0]
        if len(mine):
            found = cells.scores(begin, end, anchor)[mine]
            scores, ids = _first(np.concatenate([scores, found]), np.concatenate([ids, cells.ids[begin:end][mine]]), count)
    return scores, ids


def best_in_windows(
    cells: Cells, anchor: np.ndarray, label: int, tops: list[int], count: int, low_percent: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each top score the ``count`` best rows of other labels between ``low_percent`` of it and it.

    A window is certified when it is full and its last row scores more than any unvisited cell can, or when
    no unvisited cell can reach its lower end.
    """
    found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) for _ in tops]
    open_windows = [k for k, top in enumerate(tops) if top >= 0]
    for bound, begin, end in cells.visit(anchor):
        open_windows = [k for k in open_windows if 100 * bound >= low_percent * tops[k] and not (len(found[k][0]) == count and found[k][0][-1] > bound)]
        if not open_windows:
            break
        scores = cells.scores(begin, end, anchor)
        other = (cells.labels[begin:end] != label) & (100 * scores >= low_percent * min(tops[k] for k in open_windows))
        if other.any():
            scores, ids = scores[other], cells.ids[begin:end][other]
            for k in open_windows:
                inside = (scores <= tops[k]) & (100 * scores >= low_percent * tops[k])
                if inside.any():
                    found[k] = _first(np.concatenate([found[k][0], scores[inside]]), np.concatenate([found[k][1], ids[inside]]), count)
    return found


def _meet(anchors: DataFrame, index: DataFrame, shards: int, anchor_block: int, books: dict, answer, schema: str) -> DataFrame:
    """Apply ``answer(cells, row of anchors)`` where a block of anchors meets a shard of the same dimension."""
    blocks = max(1, -(-anchors.count() // anchor_block))
    target = common.arrow_schema(index, schema)
    asked = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(max(0, shards - 1))))
    )
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {f.name: [] for f in target}
        if left.num_rows and right.num_rows:
            dim = right.column("dim")[0].as_py()
            points = matrix(right.column("vector"), dim)
            plain = {c: right.column(c).to_numpy() for c in ("vec_id", "label", "first", "second")}
            cells = Cells(plain["vec_id"], plain["label"], points, (plain["first"], plain["second"]), centres_of(books, dim))
            asking = matrix(left.column("vector"), dim)
            for row, anchor in zip(left.drop_columns(["vector"]).to_pylist(), asking, strict=True):
                for values in answer(cells, anchor, row):
                    for name, value in zip(out, values, strict=True):
                        out[name].append(value)
        return pa.table([pa.array(out[f.name], type=f.type) for f in target], schema=target)

    keys = ("block", "shard", "dim")
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(run, schema)


def mine(
    vectors: DataFrame,
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    scale: int = SCALE,
    codes: int = CODES,
    sample: int = SAMPLE,
    shard_rows: int = SHARD_ROWS,
    anchor_block: int = ANCHOR_BLOCK,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): the hard negatives of each positive.

    Anchors are the rows whose id is divisible by ``every``; their positives are the best other rows of their
    label by inner product of the whole-number vectors (ties: the smaller id). Negatives are the best rows of other
    labels that score no more than the positive and at least ``low_percent`` per cent of it; a positive below 0
    has none. Exact, whatever the codebooks are. Vectors of another dimension than the anchor's are no candidates.
    See ``usable_rows`` for nulls and repeated ids; an empty table gives no rows; other columns are ignored.
    A score beyond a long is an error.
    """
    rows = materialise(usable_rows(vectors, scale, id_column, vector_column, label_column), "vectors")
    books = fit_codebooks(rows, codes, sample)
    dealt, shards = with_shards(materialise(with_codes(rows, books), "coded"), shard_rows)
    index = materialise(dealt, "cells")
    anchors = index.where(F.pmod("vec_id", F.lit(every)) == 0).select("vec_id", "label", "vector", "dim")

    def alike(cells: Cells, anchor: np.ndarray, row: dict) -> Iterator[tuple]:
        scores, ids = best_alike(cells, anchor, row["vec_id"], row["label"], positives)
        for score, found in zip(scores.tolist(), ids.tolist(), strict=True):
            yield row["vec_id"], found, score

    near = _meet(anchors, index, shards, anchor_block, books, alike, "anchor_id long, positive_id long, positive_score long")
    place = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = near.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= positives)
    # At most ``positives`` entries each.
    paired = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("found"))
    paired = materialise(paired, "positives")
    asking = materialise(anchors.join(paired.withColumnRenamed("anchor_id", "vec_id"), "vec_id"), "anchors")

    def windows(cells: Cells, anchor: np.ndarray, row: dict) -> Iterator[tuple]:
        tops = [f["positive_score"] for f in row["found"]]
        for positive, (scores, ids) in zip(row["found"], best_in_windows(cells, anchor, row["label"], tops, negatives, low_percent), strict=True):
            for score, found in zip(scores.tolist(), ids.tolist(), strict=True):
                yield row["vec_id"], positive["positive_id"], found, positive["positive_score"], score

    schema = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    hard = _meet(asking, index, shards, anchor_block, books, windows, schema)
    place = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hard.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
