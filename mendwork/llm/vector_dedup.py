"""Near-duplicate vectors by random-hyperplane signs in several tables, with exact cosines.

A table's key is the signs of a vector's products with some random planes; vectors at an angle t share it with the
chance (1 - t / pi) ** bits. Bits grow with the logarithm of the number of rows, so that strangers share few keys,
and tables are as many as a pair at the threshold needs to be missed as seldom as asked.

Groups of copies are not compared pair by pair. Equal vectors are one vector with a weight. Then each vector looks
for a centre: of the smallest ids in its buckets the one it shares most tables with. If their angle is at most half
the threshold's, it lies in the centre's ball, and by the triangle inequality any two vectors of a ball are linked,
which is counted and not listed. Only vectors of different balls that share a key are compared, in blocks of bounded
size, and counted in the first table that they share. A ball that fills blocks of its own does not meet itself.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendwork.session import materialise

from . import common
from .common import arrow_schema
from .components import components
from .vantage import valid_vectors

common.ship(__name__)

COSINE = 0.95
# The chance to miss a pair exactly at the threshold.
MISS = 0.002
# Keys have so many bits more than it takes to number the rows.
SPARE_BITS = 4
MOST_BITS = 60
BLOCK_ROWS = 2048

SIGNATURES = "id long, class binary, dim int, unit array<double>, keys array<long>"


def layout(rows: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(bits of a key, tables) for so many rows."""
    bits = min(MOST_BITS, max(8, math.ceil(math.log2(max(rows, 2))) + SPARE_BITS))
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-agree)))


def recall(cosine: float, bits: int, tables: int) -> float:
    """The chance that two vectors of this cosine share a key in one of the tables."""
    agree = (1 - math.acos(min(1.0, cosine)) / math.pi) ** bits
    return 1 - (1 - agree) ** tables


def sign_keys(units: np.ndarray, bits: int, tables: int, seed: int = 13) -> np.ndarray:
    """One key per row and table; the planes follow from the seed and the dimension."""
    planes = np.random.default_rng([seed, units.shape[1]]).standard_normal((tables * bits, units.shape[1]))
    signs = (units @ planes.T > 0).reshape(len(units), tables, bits)
    return (signs.astype(np.int64) << np.arange(bits, dtype=np.int64)).sum(axis=2)


def unit_rows(points: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by their largest component first, so that no square overflows."""
    points = points / np.abs(points).max(axis=1, keepdims=True)
    return points / np.sqrt((points**2).sum(axis=1, keepdims=True))


def signatures(points: DataFrame, bits: int, tables: int) -> DataFrame:
    """Unit vector, a digest of it and the keys, for every row of (vec_id, vector)."""
    target = arrow_schema(points, SIGNATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
            for dim in np.unique(sizes).tolist():
                some = batch.take(pa.array(np.nonzero(sizes == dim)[0]))
                units = unit_rows(some.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)) + 0.0
                keys = sign_keys(units, bits, tables)
                digests = [hashlib.blake2b(u.tobytes(), digest_size=16).digest() for u in units]
                offsets = np.arange(len(units) + 1, dtype=np.int32)
                arrays = [
                    some.column(0),
                    pa.array(digests, pa.binary()),
                    pa.array(np.full(len(units), dim, dtype=np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets * dim, pa.int32()), pa.array(units.ravel())),
                    pa.ListArray.from_arrays(pa.array(offsets * tables, pa.int32()), pa.array(keys.ravel())),
                ]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, target, strict=True)], schema=target)

    return points.select("vec_id", "vector").mapInArrow(run, SIGNATURES)


def linked_pairs(units: np.ndarray, balls: np.ndarray, keys: np.ndarray, table: int, left: np.ndarray, home: bool, cosine: float) -> np.ndarray:
    """Which rows are linked and counted here: alike, of different balls, in no earlier table together.

    ``left`` marks the rows of the first block; ``home`` says whether pairs within a block count.
    """
    alike = units @ units.T >= cosine
    alike &= balls[:, None] != balls[None, :]
    if not home:
        alike &= left[:, None] != left[None, :]
    for earlier in range(table):
        if not alike.any():
            break
        alike &= keys[:, None, earlier] != keys[None, :, earlier]
    return alike


def spanning(alike: np.ndarray) -> np.ndarray:
    """For every row another one that it is linked with, so that all these links connect what is connected; -1 for a first row."""
    parent, seen = np.full(len(alike), -1), np.zeros(len(alike), dtype=bool)
    for start in np.nonzero(alike.any(axis=1))[0].tolist():
        if seen[start]:
            continue
        seen[start] = True
        turn = [start]
        while turn:
            x = turn.pop()
            more = np.nonzero(alike[x] & ~seen)[0]
            seen[more], parent[more] = True, x
            turn.extend(more.tolist())
    return parent


def _cosine(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def with_balls(reps: DataFrame, keyed: DataFrame, cosine: float) -> DataFrame:
    """(id, ball): the centre of the ball that a vector lies in, or its own id."""
    pivots = keyed.groupBy("dim", "table", "key").agg(F.min("id").alias("pivot"), F.max("id").alias("top")).where("pivot != top").drop("top")
    shared = keyed.join(pivots, ["dim", "table", "key"]).groupBy("id", "pivot").agg(F.count("*").alias("n"))
    chosen = shared.groupBy("id").agg(F.max(F.struct("n", (-F.col("pivot")).alias("minus"))).alias("best"))
    asked = chosen.select("id", (-F.col("best.minus")).alias("pivot")).where("id != pivot")
    centres = reps.select(F.col("id").alias("pivot"), F.col("unit").alias("centre"))
    close = reps.select("id", "unit").join(asked, "id").join(centres, "pivot")
    # The slack keeps rounding from linking what is not.
    half = math.cos(math.acos(cosine) / 2) + 1e-9
    inside = close.where(_cosine("unit", "centre") >= half).select("id", "pivot")
    return reps.select("id").join(inside, "id", "left").select("id", F.coalesce("pivot", "id").alias("ball"))


def in_blocks(keyed: DataFrame, balls: DataFrame, block_rows: int) -> DataFrame:
    """(dim, table, key, id, low, high, mine): the blocks that meet where a key is shared by several balls.

    Balls with a block's worth of rows in a bucket get blocks of their own, which don't meet each other; the rest
    of a bucket is dealt by a hash. So what a large ball costs grows with its rows and not with their square.
    """
    bucket = ["dim", "table", "key"]
    own = materialise(keyed.join(balls, "id"), "buckets")
    counted = own.groupBy(*bucket, "ball").agg(F.count("*").alias("n"))
    mixed = counted.groupBy(*bucket).agg(F.min("ball").alias("low_ball"), F.max("ball").alias("high_ball")).where("low_ball != high_ball")
    counted = materialise(counted.join(mixed.select(*bucket), bucket, "left_semi"), "ball-counts")
    large = F.col("n") >= block_rows
    group = F.when(large, F.col("ball"))
    parts = counted.groupBy(*bucket, group.alias("whose")).agg(F.ceil(F.sum("n") / block_rows).cast("int").alias("split"))
    # One entry per block and not per row.
    blocks = parts.select(*bucket, "whose", F.explode(F.sequence(F.lit(0), F.col("split") - 1)).alias("part"))
    name = F.xxhash64(F.coalesce("whose", F.lit(-1)), F.col("whose").isNull(), "part")
    listed = blocks.select(*bucket, F.struct(name.alias("block"), "whose").alias("b")).groupBy(*bucket).agg(F.collect_list("b").alias("others"))
    sized = counted.select(*bucket, "ball", group.alias("whose")).join(
        parts.withColumnRenamed("whose", "of"), bucket
    ).where(F.col("whose").eqNullSafe(F.col("of"))).drop("of")
    placed = own.join(sized, [*bucket, "ball"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("split")).cast("int")).withColumn("mine", name)
    met = placed.join(listed, bucket).select(*bucket, "id", "whose", "mine", F.explode("others").alias("other"))
    met = met.where(F.col("whose").isNull() | F.col("other.whose").isNull() | (F.col("whose") != F.col("other.whose")))
    return met.select(*bucket, "id", "mine", F.least("mine", "other.block").alias("low"), F.greatest("mine", "other.block").alias("high"))


def vector_groups(
    vectors: DataFrame,
    cosine: float = COSINE,
    miss: float = MISS,
    block_rows: int = BLOCK_ROWS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors of a cosine of at least ``cosine`` are linked; ``component_id`` is the smallest id that is reachable.
    A pair is missed with a chance of at most ``miss`` at the threshold and less above; no pair below is linked.
    Null or zero vectors and those with a null or non-finite component are linked with nothing, as is a row without
    an id, whose ``component_id`` is null and which is kept. Rows that repeat an id are one vector (of different
    ones the smallest in array order); each such row is returned. Vectors of different dimensions are not linked.
    Other columns are ignored; an empty table gives no rows.
    """
    points = materialise(valid_vectors(vectors, id_column, vector_column), "vectors")
    bits, tables = layout(points.count(), cosine, miss)
    found = materialise(signatures(points, bits, tables), "signatures")
    # Equal unit vectors are one class; its smallest id stands for it from here on.
    first = F.min_by(F.struct("unit", "keys"), "id").alias("first")
    classes = found.groupBy("dim", "class").agg(F.min("id").alias("id"), F.count("*").alias("weight"), first)
    reps = materialise(classes.select("id", "dim", "class", "weight", "first.unit", "first.keys"), "classes")

    keyed = materialise(reps.select("id", "dim", F.posexplode("keys").alias("table", "key")), "keys")
    balls = materialise(with_balls(reps, keyed, cosine), "balls")
    met = in_blocks(keyed, balls, block_rows)
    rows = met.join(reps.select("id", "weight", "unit", "keys"), "id").join(balls, "id")

    def compare(key, table):
        place, low, high = key[1].as_py(), key[3].as_py(), key[4].as_py()
        ids, weights, own = (table.column(c).to_numpy() for c in ("id", "weight", "ball"))
        units, keys = (np.array(table.column(c).combine_chunks().flatten()).reshape(len(ids), -1) for c in ("unit", "keys"))
        alike = linked_pairs(units, own, keys, place, table.column("mine").to_numpy() == low, low == high, cosine)
        parent = spanning(alike)
        at = np.nonzero(alike.any(axis=1))[0]
        return pa.table(
            {
                "id": pa.array(ids[at], pa.int64()),
                "ball": pa.array(own[at], pa.int64()),
                "gained": pa.array(alike[at] @ weights, pa.int64()),
                "other": pa.array(own[parent[at]], pa.int64(), mask=parent[at] < 0),
            }
        )

    grouped = rows.groupBy("dim", "table", "key", "low", "high")
    across = materialise(grouped.applyInArrow(compare, "id long, ball long, gained long, other long"), "links")

    # Balls are the nodes from here on: a large one is a single node.
    edges = across.select(F.col("ball").alias("a"), F.col("other").alias("b")).union(balls.select(F.col("id").alias("a"), F.col("ball").alias("b")).join(
        balls.select(F.col("ball").alias("a")).distinct(), "a", "left_semi"
    ))
    groups = components(edges.distinct()).select(F.col("id").alias("ball"), F.col("component").alias("group"))
    sizes = balls.join(reps.select("id", "weight"), "id").groupBy("ball").agg(F.sum("weight").alias("size"), F.min("id").alias("lowest"))
    sizes = sizes.join(groups, "ball", "left").withColumn("group", F.coalesce("group", "ball"))
    lowest = sizes.groupBy("group").agg(F.min("lowest").alias("component_id"))
    sizes = materialise(sizes.join(lowest, "group").select("ball", "size", "component_id"), "groups")
    gained = across.groupBy("id").agg(F.sum("gained").alias("gained"))
    linked = balls.join(gained, "id", "left").join(sizes, "ball")
    linked = linked.select("id", (F.col("size") - 1 + F.coalesce("gained", F.lit(0))).alias("n_links"), "component_id")
    of_class = reps.select("id", "dim", "class").join(linked, "id").drop("id")
    members = found.select(F.col("id").alias("vec_id"), "dim", "class").join(of_class, ["dim", "class"]).select("vec_id", "n_links", "component_id")

    every = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id")).join(members, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return every.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
