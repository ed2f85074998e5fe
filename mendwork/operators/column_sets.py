"""What sets of columns determine or give away: minimal dependencies, smallest identifying sets.

Both search the lattice of column sets level by level and count the groups of a level's sets in one pass. Rows
are first counted by their values in all columns, so repeated rows are one row from then on. What a set can't
add, because a smaller one already decides it, is not counted. Only one row per column set comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from mendwork.session import materialise

Set = frozenset[int]


def _counted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per combination of values, the columns named by their number."""
    named = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    return materialise(named.groupBy(*named.columns).agg(F.count("*").alias("n")), "combinations")


def _per_set(counted: DataFrame, sets: Sequence[Set], width: int, *aggregates: Column) -> dict[Set, tuple]:
    """Aggregates over the groups (column ``size``) of every set; missing values are a value of their own."""
    if not sets:
        return {}
    names = [f"c{i}" for i in range(width)]
    groups = counted.groupingSets([[names[i] for i in sorted(s)] for s in sets], *names).agg(
        F.sum("n").alias("size"), F.grouping_id().alias("out")
    )
    # Bits of the columns that are not in the set; the first column has the highest.
    numbers = {sum(1 << (width - 1 - i) for i in range(width) if i not in s): s for s in sets}
    return {numbers[r["out"]]: tuple(r)[1:] for r in groups.groupBy("out").agg(*aggregates).collect()}


def minimal_dependencies(df: DataFrame, columns: Sequence[str], max_given: int | None = None) -> DataFrame:
    """(given, inferred, is_key): every minimal set of columns that determines another column.

    Of the partition by a set, only groups of two rows or more are looked at: its excess is the number of their rows
    less the number of groups. A set determines a column if adding the column leaves the excess as it is; a key has
    none. The excess of a set that contains a key or a known dependency follows from smaller sets and is not counted.
    An empty ``given`` stands for a constant column. A missing value is a value of its own. ``max_given``
    bounds the size of ``given`` (by default all sizes). In a table of one row or none, all columns are constant.
    """
    width = len(columns)
    most = min(width - 1 if max_given is None else max_given, width - 1)
    spark, counted = df.sparkSession, _counted(df, columns)
    in_groups, groups = F.coalesce(F.sum(F.when(F.col("size") > 1, F.col("size"))), F.lit(0)), F.count_if(F.col("size") > 1)
    rows = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    excess: dict[Set, int] = {frozenset(): max(rows - 1, 0)}
    keys: list[Set] = []
    found: list[tuple[Set, int]] = []

    def known(s: Set) -> int | None:
        """The excess of a set as far as it was counted or follows from a key or a dependency inside the set."""
        if s in excess:
            return excess[s]
        if any(k <= s for k in keys):
            return 0
        inner = next((a for given, a in found if a in s and given <= s - {a}), None)
        return None if inner is None else known(s - {inner})

    for size in range(most + 1):
        # Sets that could be minimal: without a dependency inside, and without a smaller key.
        free = [
            s
            for s in map(frozenset, combinations(range(width), size))
            if not any(k < s for k in keys) and not any(a in s and given <= s - {a} for given, a in found)
        ]
        keys += [s for s in free if known(s) == 0]
        wanted = [(s, a) for s in free for a in range(width) if a not in s and not any(b == a and given <= s for given, b in found)]
        fresh = list(dict.fromkeys(s | {a} for s, a in wanted if known(s | {a}) is None))
        excess |= {s: x - y for s, (x, y) in _per_set(counted, fresh, width, in_groups.alias("x"), groups.alias("y")).items()}
        found += [(s, a) for s, a in wanted if known(s) == known(s | {a})]
    lines = [([columns[i] for i in sorted(given)], columns[a], given in keys) for given, a in sorted(found, key=lambda f: (len(f[0]), sorted(f[0]), f[1]))]
    return spark.createDataFrame(lines, StructType.fromDDL("given array<string>, inferred string, is_key boolean"))


def smallest_identifying_sets(df: DataFrame, columns: Sequence[str], k: int, max_size: int | None = None) -> DataFrame:
    """(columns, smallest_group, small_groups, rows_at_risk): the smallest sets under which a group has fewer than ``k`` rows.

    A set with a group of fewer than ``k`` rows lets rows be singled out, and so does every larger set; so
    supersets of a set found are not looked at. A missing value is a value of its own. An empty table has no groups.
    """
    width = len(columns)
    spark, counted = df.sparkSession, _counted(df, columns)
    small = F.col("size") < k
    aggregates = (
        F.min("size").alias("low"),
        F.count_if(small).alias("groups"),
        F.coalesce(F.sum(F.when(small, F.col("size"))), F.lit(0)).alias("rows"),
    )
    found: dict[Set, tuple] = {}
    for size in range(1, min(width, max_size or width) + 1):
        open_sets = [s for s in map(frozenset, combinations(range(width), size)) if not any(f <= s for f in found)]
        if not open_sets:
            break
        found |= {s: values for s, values in _per_set(counted, open_sets, width, *aggregates).items() if values[0] < k}
    lines = [([columns[i] for i in sorted(s)], *found[s]) for s in sorted(found, key=lambda s: (len(s), sorted(s)))]
    schema = "columns array<string>, smallest_group long, small_groups long, rows_at_risk long"
    return spark.createDataFrame(lines, StructType.fromDDL(schema))
