"""The paths that large tables take, forced on small ones, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mendwork.functions.numeric import float_text, to_number
from mendwork.operators import canonical, duplicates, impute, keys, outliers, quantiles, star
from mendwork.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def _values(kind: str) -> list[float | None]:
    rng = random.Random(7)
    return {
        "uniform": [rng.uniform(-100, 100) for _ in range(3000)],
        "one hot value": [5.0] * 1000 + [rng.gauss(0, 1) for _ in range(2000)],
        "all equal": [42.0] * 500,
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(2000)],
        "close together": [1.0 + i * 2.0**-50 for i in range(2000)],
        "with gaps": [None, float("nan"), 0.0, -0.0, 1.0, 2.0] * 100,
        "single": [3.5],
    }[kind]


@pytest.mark.parametrize(
    "kind", ["uniform", "one hot value", "all equal", "wide", "close together", "with gaps", "single"]
)
@pytest.mark.parametrize("range_rows", [1, 50, 100_000])
def test_quantiles(spark, kind, range_rows):
    values = _values(kind)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    row = exact_quantiles(df, "v", PROBS, range_rows=range_rows).first()
    kept = np.array([v for v in values if v is not None and v == v])
    assert row.n == len(kept)
    # The same doubles as numpy's, at any depth of the search.
    assert [row[f"q{i}"] for i in range(len(PROBS))] == np.quantile(kept, PROBS).tolist()


def test_quantiles_with_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in [-inf, -inf, 1.0, 2.0, inf, inf, inf]], "v double")
    row = exact_quantiles(df, "v", [0.0, 0.1, 0.25, 0.5, 0.75, 1.0], range_rows=1).first()
    assert tuple(row) == (7, -inf, -inf, -inf, 2.0, inf, inf)


def test_clustered_values_leave_a_small_range(spark):
    rng = random.Random(2)
    values = [1e6 + rng.uniform(-0.02, 0.02) for _ in range(20_000)] + [rng.uniform(0, 1e9) for _ in range(20)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(8)
    row = exact_quantiles(df, "v", [0.25, 0.5], range_rows=200).first()
    assert (row.q0, row.q1) == tuple(np.quantile(values, [0.25, 0.5]))


def test_quantiles_by_range_in_groups_with_null_group(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.gauss(0, 10)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.q0 for r in exact_quantiles(df, "v", [0.3], ["g"], range_rows=20).collect()}
    for g in ("a", "b", None):
        assert np.isclose(got[g], np.quantile([v for h, v in rows if h == g], 0.3))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    row = exact_quantiles(df, "v", [0.5]).first()
    assert row.q0 is None and row.n == 0
    assert outliers.with_outlier_flag(df, "v").first().outlier_flag is False
    groups = spark.createDataFrame([("a", None), ("b", 2.0), (None, None)], "g string, v double")
    got = {r.g: (r.n, r.q0) for r in exact_quantiles(groups, "v", [0.5], ["g"]).collect()}
    assert got == {"a": (0, None), "b": (1, 2.0), None: (0, None)}


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("kind", ["uniform", "ties", "one hot value", "infinities", "wide"])
def test_quantiles_from_narrowed_brackets(spark, monkeypatch, kind, by):
    """More rows than a bracket may hold: found by one sketch, and by sketches inside sketches."""
    rng = np.random.default_rng(4)
    n = 60_000
    values = {
        "uniform": rng.uniform(-1, 1, n),
        "ties": rng.integers(0, 40, n).astype(float),
        "one hot value": np.where(rng.random(n) < 0.4, 7.0, rng.normal(7, 1, n)),
        "infinities": np.concatenate([np.full(n // 4, -np.inf), np.full(n // 4, np.inf), rng.normal(0, 1, n // 2)]),
        "wide": rng.choice([-1.0, 1.0], n) * 10 ** rng.uniform(-300, 300, n),
    }[kind]
    groups = np.where(rng.random(n) < 0.5, "hot", np.where(rng.random(n) < 0.9, "warm", None)) if by else np.full(n, "hot")
    data = [(g, float(v)) for g, v in zip(groups.tolist(), values, strict=True)]
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    monkeypatch.setattr(quantiles, "LEAST_ROWS", 3500)
    # Then a bracket with more than a few rows is cut by further sketches.
    monkeypatch.setattr(quantiles, "MARGIN", 0.03)
    for write in (False, True):
        for row in exact_quantiles(df, "v", PROBS, by, range_rows=1, write=write).collect():
            mine = values if not by else values[[g == row.g for g in groups]]
            assert row.n == len(mine)
            with np.errstate(invalid="ignore"):
                want = np.quantile(mine, PROBS, method="linear").tolist()
            got = [row[f"q{i}"] for i in range(len(PROBS))]
            assert [a for a, b in zip(got, want, strict=True) if b == b] == [b for b in want if b == b]


def test_a_hundred_thousand_segments_and_a_hot_one(spark):
    segment = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id"))
    df = spark.range(400_000).select(F.nullif(segment % 200_000, F.lit(77)).alias("s"), (F.hash("id") % 1000).cast("double").alias("v"))
    got = outliers.iqr_bounds(df, "v", outliers.SIGNED, by=["s"])
    want = df.groupBy("s").agg(F.count("v").alias("n"), F.percentile("v", [0.25, 0.75]).alias("q"))
    both = got.join(want.withColumnRenamed("n", "m"), got.s.eqNullSafe(want.s))
    assert both.count() == got.count() == 100_001
    same = (F.col("n") == F.col("m")) & (F.abs(F.col("q1") - F.get("q", F.lit(0))) < 1e-9) & (F.abs(F.col("q3") - F.get("q", F.lit(1))) < 1e-9)
    assert both.where(~same).count() == 0


def _check_rank(df, order_by, **options):
    ranked = keys.with_row_rank(df, order_by, "rank", **options).collect()
    position = {tuple(r[c] for c in order_by): r["rank"] for r in ranked}
    assert sorted(r["rank"] for r in ranked) == list(range(1, len(ranked) + 1))
    want = [tuple(r) for r in df.orderBy(*order_by).select(*order_by).collect()]
    assert [position[w] for w in want] == list(range(1, len(want) + 1))


def test_key_slices_with_a_hot_leading_value(spark):
    rng = random.Random(5)
    rows = [(20 if rng.random() < 0.4 else rng.randint(-50, 10**9), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a long, b long")
    _check_rank(df, ["a", "b"], slices=30)


def test_key_slices_of_texts_dates_and_nulls(spark):
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("aäzé中") for _ in range(rng.randint(0, 9))) for _ in range(400)})
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "w string")
    _check_rank(df, ["w"], slices=20)
    days = spark.range(900).select(F.expr("cast(date_add(date'1969-01-01', cast(id as int)) as timestamp_ntz) + make_dt_interval(0, 1, 2, id % 60) AS d"))
    _check_rank(days, ["d"], slices=18)


SLICED = {
    "hot leading value": (["1 AS a", "id AS b"], ["a", "b"]),
    "texts with a common start": (["format_string('CUST_%012d', id * 7919 % 20000) AS a"], ["a"]),
    "times of one month": (["cast(timestamp_seconds(1.7e9 + id * 120) as string) AS a"], ["a"]),
    "burst of times": (["timestamp_micros(cast(1700000000000000 + if(id % 50 = 0, id * 1000000000, id) as bigint)) AS a"], ["a"]),
    "clustered doubles": (["if(id % 100 = 0, id * 1e6, 1e6 + id * 1e-9) AS a", "id AS b"], ["a", "b"]),
    "ids and times as texts": (["cast(id % 99 as string) AS id", "cast(id as string) AS time"], ["id", "time"]),
}


def test_rows_move_once_for_their_key(spark, monkeypatch):
    """One exchange of full rows: to their range. Sizes and starts are a few numbers."""
    df = spark.range(200_000).selectExpr("if(id % 100 = 0, id * 1000000, id % 977) AS a", "id AS b", "repeat('x', 50) AS wide").repartition(8, "b")
    plans = []
    plain = keys.materialise
    monkeypatch.setattr(keys, "materialise", lambda rows, name: plans.append(rows) or plain(rows, name))
    ranked = keys.with_row_rank(df, ["a", "b"], "rank", slices=20)
    text = "\n".join(p._jdf.queryExecution().optimizedPlan().toString() for p in [*plans, ranked])
    assert text.count("RepartitionByExpression") == 1
    late = ranked._jdf.queryExecution().executedPlan().toString()
    assert all("wide" not in line for line in late.splitlines() if "Exchange" in line)
    assert "row_number" not in late
    order = ranked.orderBy("rank").select("a", "b").collect()
    assert order == df.orderBy("a", "b").select("a", "b").collect()


@pytest.mark.parametrize("kind", SLICED)
def test_slices_hold_about_equally_many_rows(spark, kind):
    columns, order_by = SLICED[kind]
    df = spark.range(0, 20000, 1, 8).selectExpr(*columns)
    ranked = keys.with_row_rank(df, order_by, "rank", slices=20)
    _check_rank(df, order_by, slices=20)
    # The ranges that were written: none holds more than twice its share.
    written = spark.read.parquet(sorted({f.rsplit("/", 1)[0] for f in ranked.inputFiles()})[0])
    assert max(r["count"] for r in written.groupBy("_slice").count().collect()) <= 2000


@pytest.mark.parametrize("partitions", [1, 64])
def test_same_result_for_any_partitioning(spark, partitions):
    df = spark.range(5000).select("id", (F.col("id") * 7919 % 1000).cast("double").alias("v")).repartition(partitions)
    row = outliers.iqr_bounds(df, "v").first()
    assert (row.q1, row.q3) == tuple(np.quantile([i * 7919 % 1000 for i in range(5000) if i * 7919 % 1000], [0.25, 0.75]))
    ranked = keys.with_row_rank(df, ["id"], "rank", slices=17)
    assert ranked.filter("rank <> id + 1").count() == 0


def test_identical_rows_with_nulls(spark):
    rows = [(1, None), (None, 1), (1, None), (2, 2), (None, None), (None, None), (3, 1)]
    df = spark.createDataFrame(rows, "a int, b int")
    groups = {(r.a, r.b): r.duplicate_count for r in duplicates.duplicate_row_groups(df).collect()}
    assert groups == {(1, None): 2, (None, None): 2}
    keyed = df.withColumn("k", F.monotonically_increasing_id())
    assert duplicates.duplicate_row_members(keyed, ["a", "b"]).count() == 4


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("x", 2), ("x", 1), ("y", 5), ("y", 5), ("y", 1), ("z", None)], "g string, v int")
    modes = {r.g: r.m for r in impute.most_frequent(df, "v", ["g"], "m").collect()}
    assert modes == {"x": 1, "y": 5}
    filled = {r.g: r.v for r in impute.fill_mode_hierarchy(df, "v", [["g"], []]).filter("g = 'z'").collect()}
    assert filled == {"z": 1}


def test_dependency_is_only_used_where_it_is_unique(spark):
    rows = [("c", 1.0, "a"), ("c", 1.0, None), ("c", 2.0, "x"), ("c", 2.0, "y"), ("c", 2.0, None), (None, 1.0, None)]
    df = spark.createDataFrame(rows, "g string, p double, item string")
    filled = sorted((str(r.g), r.p, str(r.item)) for r in impute.infer_by_dependency(df, ["g", "p"], "item").collect())
    assert filled == [("None", 1.0, "None"), ("c", 1.0, "a"), ("c", 1.0, "a"), ("c", 2.0, "None"), ("c", 2.0, "x"), ("c", 2.0, "y")]


def test_lookups_with_repeated_keys_are_refused(spark):
    lookup = spark.createDataFrame([("a", "A"), ("a", "B"), (None, "C")], "variant string, canonical string")
    df = spark.createDataFrame([("a",), (None,)], "v string")
    with pytest.raises(ValueError, match="variant"):
        canonical.canonicalise_by_table(df, "v", lookup)
    with pytest.raises(ValueError, match="name"):
        star.star_fact(df, {"v": star.Dimension(lookup.selectExpr("variant AS name", "canonical AS id"), "name", "id")})
    assert canonical.canonicalise_by_table(df, "v", lookup.limit(1)).count() == 2


def test_numbers_in_and_out(spark):
    texts = ["1e308", "1.5e308", "0.001e309", "1" * 400, "-1e400", "1e400", "5e-324", "1e-400", "100d", "nan", "inf"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(to_number(F.col("t")).alias("x"))
    assert [r.x for r in df.collect()] == [1e308, 1.5e308, 0.001e309, None, None, None, 5e-324, 0.0, None, None, None]
    numbers = [0.0005, 0.0001, 0.00012345678901234567, 100.0, 12345678.5, 1e15, 1e-5, -0.00025]
    df = spark.createDataFrame([(x,) for x in numbers], "x double").select(float_text(F.col("x")).alias("t"))
    got = [r.t for r in df.collect()]
    assert got[:6] == ["0.0005", "0.0001", "0.00012345678901234567", "100.0", "12345678.5", "1000000000000000.0"]
    assert got[7] == "-0.00025" and [float(t) for t in got] == numbers


def test_tables_can_be_dropped(spark):
    from mendwork.session import drop_tables, materialise

    df = materialise(spark.range(5), "probe")
    assert df.count() == 5
    assert drop_tables(spark) >= 1
    assert drop_tables(spark) == 0
