"""Dependencies and identifying sets against trying all subsets; proposals against all pairs; states of a snapshot."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from mendwork.operators import canonical, column_sets, quality

COLUMNS = ["a", "b", "c", "d e"]


def _sets(width, least=0, most=None):
    return [c for size in range(least, (width if most is None else most) + 1) for c in combinations(range(width), size)]


def _groups(rows, of):
    return Counter(tuple(r[i] for i in of) for r in rows)


def brute_dependencies(rows, columns, max_given):
    width = len(columns)
    held = [
        (given, a)
        for given in _sets(width, 0, min(width - 1, max_given))
        for a in range(width)
        if a not in given and len(_groups(rows, given)) == len(_groups(rows, sorted({*given, a})))
    ]
    minimal = [(g, a) for g, a in held if not any(b == a and set(s) < set(g) for s, b in held)]
    return sorted((tuple(columns[i] for i in g), columns[a], len(_groups(rows, g)) == len(rows)) for g, a in minimal)


def brute_identifying(rows, columns, k):
    risky = {s: _groups(rows, s) for s in _sets(len(columns), 1)}
    risky = {s: g for s, g in risky.items() if g and min(g.values()) < k}
    out = []
    for s, groups in risky.items():
        if not any(set(t) < set(s) for t in risky):
            small = [n for n in groups.values() if n < k]
            out.append((tuple(columns[i] for i in s), min(small), len(small), sum(small)))
    return sorted(out)


def _table(kind):
    rng = random.Random(kind)
    if kind == "empty":
        return []
    if kind == "one":
        return [(1, 2, None, 4)]
    if kind == "copies":
        return [(1, 2, 3, 4)] * 5
    if kind == "derived":
        return [(x, x % 3, rng.randrange(4), (x % 3) * 2) for x in (rng.randrange(9) for _ in range(60))]
    if kind == "key pair":
        return [(x, y, x * 10 + y, 7) for x in range(5) for y in range(4)]
    return [tuple(rng.choice([None, 1, 2, 3]) for _ in COLUMNS) for _ in range(rng.randrange(5, 40))]


@pytest.mark.parametrize("kind", ["empty", "one", "copies", "derived", "key pair", 1, 2, 3])
def test_column_sets_like_all_subsets(spark, kind):
    rows = _table(kind)
    df = spark.createDataFrame(rows, "a int, b int, c int, `d e` int").repartition(3)
    for most in (1, 3):
        found = column_sets.minimal_dependencies(df, COLUMNS, most).collect()
        assert sorted((tuple(r.given), r.inferred, r.is_key) for r in found) == brute_dependencies(rows, COLUMNS, most)
    for k in (2, 5):
        found = column_sets.smallest_identifying_sets(df, COLUMNS, k).collect()
        got = sorted((tuple(r["columns"]), r.smallest_group, r.small_groups, r.rows_at_risk) for r in found)
        assert got == brute_identifying(rows, COLUMNS, k)


def test_sets_that_follow_are_not_counted(spark, monkeypatch):
    counted = []
    plain = column_sets._per_set
    monkeypatch.setattr(column_sets, "_per_set", lambda c, sets, *more: counted.extend(sets) or plain(c, sets, *more))
    df = spark.createDataFrame([(i, i % 5, i % 5 * 2, 1, i % 7) for i in range(70)], "a int, b int, c int, d int, e int")
    column_sets.minimal_dependencies(df, df.columns)
    # a is a key, d is constant, b and c determine each other: of 31 sets the single columns and a few pairs are counted.
    assert len(counted) <= 11


def _distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


@pytest.mark.parametrize("distance", [1, 2])
def test_proposals_like_all_pairs(spark, distance):
    rng = random.Random(distance)
    mapping = {"visa": "Visa", "vsa": "Visa", "amex": "Amex", "tehran": "Tehran", "qom": "Qom", "rom": "Rome", "é漢": "Étude"}
    raw = [None, "", " Visa ", "VISA", "xom", "om", "qm", "tehr@n", "t", "zzzzzzz", "é漢x", "漢é"]
    for _ in range(150):
        word = list(rng.choice([*mapping, "rome", "étude"]))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randrange(2)] = rng.choice(["", "x", "e"])
        raw.append("".join(word))
    known = {**mapping, **{v.lower(): v for v in mapping.values()}}
    want = {}
    for text, n in Counter(t.strip() for t in raw if t and t.strip()).items():
        if text.lower() in mapping:
            continue
        near = sorted((min(_distance(text.lower(), k) for k, v in known.items() if v == name), name) for name in set(known.values()))
        if near[0][0] <= distance:
            want[text] = (n, near[0][1], near[0][0], sum(d == near[0][0] for d, _ in near))
    df = spark.createDataFrame([(r,) for r in raw], "t string")
    got = canonical.propose_mapping(df, "t", mapping, distance).collect()
    assert {r.raw_value: (r.row_count, r.proposed, r.distance, r.n_proposals) for r in got} == want


def test_a_new_day_adds_to_the_stored_states(spark, tmp_path):
    def rows(days):
        data = [(d, s, s if s != "x" else None, s == "x", a) for d in days for s, a in (("success", "5"), ("x", "-1"), (None, None))]
        df = spark.createDataFrame(data, "day string, status string, status_clean string, status_invalid_flag boolean, amount string")
        return df.selectExpr(
            "*", "day AS time", "true AS time_valid_flag", "false AS time_invalid_flag", "false AS amount_outlier_flag",
            "amount IS NULL AS amount_non_numeric_flag", "try_cast(amount AS double) AS amount_clean")

    path, categories = str(tmp_path / "states"), ["status"]
    first, second = ["2025-01-01", "2025-01-02", None], ["2025-01-03"]
    for days in (first, second, second, ["2025-01-02"]):
        quality.store_states(quality.snapshot_states(rows(days), F.col("day"), categories), path)
    merged = quality.merged_snapshot(spark.read.parquet(path), categories)
    whole = quality.quality_snapshot(rows([*first, *second]), categories)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    assert spark.read.parquet(path).count() == 4
