"""Hard negatives and near-duplicate vectors against comparing all rows, and awkward rows."""

from __future__ import annotations

import math
import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from mendwork.llm import hard_negatives, vector_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, id long, ball long, block string, dim int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "b", 3) for r in rows], SCHEMA)


def clusters(seed: int, groups: list[int], strangers: int, dim: int, noise: float) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = [rng.standard_normal(dim) + noise * rng.standard_normal((n, dim)) for n in groups]
    return np.concatenate([*parts, rng.standard_normal((strangers, dim))]).astype(np.float32)


AWKWARD = [
    (1, [1.0, 0.0, 0.0, 0.0], 1), (2, [1.0, 0.0, 0.0, 0.0], 1), (2, [1.0, 0.0, 0.0, 0.0], 1), (3, [2.0, 0.0, 0.0, 0.0], 2),
    (4, None, 1), (5, [], 1), (6, [0.0] * 4, 1), (7, [None, 1.0, 0.0, 0.0], 1), (8, [math.nan, 1.0, 0.0, 0.0], 2),
    (9, [math.inf, 1.0, 0.0, 0.0], 2), (10, [1.0, 0.0, 0.0], 2), (11, [-1.0, 0.0, 0.0, 0.0], None), (None, [1.0, 0.0, 0.0, 0.0], 1),
    (None, None, None), (100, [1.0, 0.1, 0.0, 0.0], 1), (200, [1.0, 0.0, 0.0], 2), (12, [-0.0, 5.0, 0.0, 0.0], 2), (13, [1.0, 0.1, 0.0, 0.0], 2),
]


def usable(rows) -> dict[int, list[float]]:
    kept: dict[int, list[float]] = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            v = np.array(v, np.float32).astype(float).tolist()
            kept[i] = min(v, kept.get(i, v))
    return kept


# ---- near-duplicate vectors ----


def plain_links(rows, cosine=0.95) -> list[tuple]:
    kept = {i: v for i, v in usable(rows).items() if any(v)}
    units = {i: np.array(v) / np.linalg.norm(v) for i, v in kept.items()}
    links = {i: [j for j, w in units.items() if i != j and len(w) == len(u) and u @ w >= cosine] for i, u in units.items()}
    low = {i: i for i in units}
    moved = True
    while moved:
        moved = False
        for i, others in links.items():
            best = min([low[i], *(low[j] for j in others)])
            if best < low[i]:
                low[i], moved = best, True
    return sorted(((i, len(links.get(i, ())), low.get(i, i), i is None or low.get(i, i) == i) for i, *_ in rows), key=repr)


def found_links(df) -> list[tuple]:
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("noise", "block_rows"), [(0.08, 2048), (0.2, 16), (0.08, 8)])
def test_vector_groups_like_all_pairs(spark, noise, block_rows):
    points = clusters(3, [60, 40, 3, 2], 80, 24, noise)
    # Copies of a member, and a multiple of one.
    points = np.concatenate([points, points[:1].repeat(50, axis=0), 4 * points[5:6]])
    ids = np.random.default_rng(1).permutation(len(points)) * 3
    rows = [(int(i), p.tolist(), 0) for i, p in zip(ids, points, strict=True)]
    # A chance of one in a million to miss a pair: all are found.
    got = found_links(vector_dedup.vector_groups(table(spark, rows), miss=1e-6, block_rows=block_rows))
    assert got == plain_links(rows)


def test_vector_groups_on_awkward_rows(spark):
    assert found_links(vector_dedup.vector_groups(table(spark, AWKWARD), miss=1e-6)) == plain_links(AWKWARD)
    assert vector_dedup.vector_groups(table(spark, [])).count() == 0
    assert found_links(vector_dedup.vector_groups(table(spark, AWKWARD[4:7]))) == plain_links(AWKWARD[4:7])


def test_a_ball_of_copies_is_not_compared_pair_by_pair(spark):
    points = clusters(5, [1500], 300, 32, 0.04)
    rows = [(i, p.tolist(), 0) for i, p in enumerate(points)]
    reps = vector_dedup.signatures(table(spark, rows).selectExpr("vec_id", "cast(embedding as array<double>) as vector"), 12, 20)
    reps = reps.selectExpr("id", "dim", "class", "1L as weight", "unit", "keys").cache()
    keyed = reps.selectExpr("id", "dim", "posexplode(keys) as (table, key)")
    balls = vector_dedup.with_balls(reps, keyed, 0.95).cache()
    assert balls.where("id < 1500").select("ball").distinct().count() < 30
    met = vector_dedup.in_blocks(keyed, balls, 64)
    work = sum(r["count"] ** 2 for r in met.groupBy("dim", "table", "key", "low", "high").count().collect())
    within = sum(r["count"] ** 2 for r in keyed.groupBy("table", "key").count().collect())
    assert work < within / 3


def test_hash_layout():
    for rows in (10, 10_000, 10**9):
        bits, tables = vector_dedup.layout(rows)
        assert vector_dedup.recall(0.95, bits, tables) >= 0.998 and vector_dedup.recall(0.99, bits, tables) > 0.999999


# ---- hard negatives ----


def plain_negatives(rows, scale=256, every=100) -> list[tuple]:
    labels: dict[int, tuple] = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            mine = (label, [math.floor(float(np.float32(x)) * scale) for x in v])
            labels[i] = min(mine, labels.get(i, mine))
    out = []
    for a, (label, v) in labels.items():
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), i, k) for i, (k, w) in labels.items() if i != a and len(w) == len(v)]
        scored.sort()
        for p, i, _ in [s for s in scored if s[2] == label][:5]:
            inside = [s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(a, i, rank, s[1], -p, -s[0]) for rank, s in enumerate(inside, 1)]
    return sorted(out)


def found_negatives(df) -> list[tuple]:
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@pytest.mark.parametrize("options", [{}, {"codes": 3, "shard_rows": 40, "anchor_block": 2}, {"codes": 40, "sample": 5, "shard_rows": 100}])
def test_hard_negatives_like_all_rows(spark, options):
    points = clusters(9, [120, 60], 200, 9, 0.5)
    # Ties: equal rows under several labels.
    points = np.concatenate([points, points[:1].repeat(60, axis=0)])
    rows = [(i, p.tolist(), i % 3) for i, p in enumerate(points)]
    got = found_negatives(hard_negatives.mine(table(spark, rows), every=20, **options))
    assert got == plain_negatives(rows, every=20) and len(got) > 100


def test_hard_negatives_on_awkward_rows(spark):
    rows = [*AWKWARD, (14, [1.0, 0.0, 0.0, 0.0], 2), (15, [0.9, 0.0, 0.0], 1), (16, [1.0, 0.5, 0.0], 2)]
    for every in (1, 100):
        assert found_negatives(hard_negatives.mine(table(spark, rows), every=every)) == plain_negatives(rows, every=every)
    assert hard_negatives.mine(table(spark, [])).count() == 0


def test_scores_beyond_exact_doubles(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(4) * 2.0**22).astype(np.float32).tolist(), i % 2) for i in range(40)]
    assert found_negatives(hard_negatives.mine(table(spark, rows), every=5)) == plain_negatives(rows, every=5)


def test_cells_that_cannot_matter_are_not_visited():
    points = clusters(4, [300] * 6, 0, 16, 0.05).astype(float)
    books = (hard_negatives.k_means(points[:, :8], 8, 1), hard_negatives.k_means(points[:, 8:], 8, 2))
    codes = tuple(hard_negatives.nearest_code(h, c) for h, c in zip((points[:, :8], points[:, 8:]), books, strict=True))
    cells = hard_negatives.Cells(np.arange(1800), np.zeros(1800, np.int64), np.floor(points * 256), codes, tuple(b * 256 for b in books))
    scored = []
    plain = cells.scores
    cells.scores = lambda begin, end, anchor: scored.append(end - begin) or plain(begin, end, anchor)
    found, _ = hard_negatives.best_alike(cells, np.floor(points[0] * 256), 0, 0, 5)
    assert found.tolist() == np.sort(np.floor(points[1:] * 256) @ np.floor(points[0] * 256))[::-1][:5].astype(int).tolist()
    assert sum(scored) < 900


def test_cells_come_by_their_bounds():
    rng = np.random.default_rng(0)
    a, b = rng.standard_normal(7), rng.standard_normal(5)
    pairs = list(hard_negatives.by_bound(a, b))
    assert sorted((i, j) for i, j, _ in pairs) == [(i, j) for i in range(7) for j in range(5)]
    sums = [s for *_, s in pairs]
    assert sums == sorted(sums, reverse=True) and all(s == a[i] + b[j] for i, j, s in pairs)
