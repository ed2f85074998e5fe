"""Near-duplicate groups by MinHash with tensored banding.

A document's set is its distinct runs of ``width`` words. Two small collections of bands are computed, each
band a hash of ``rows`` minima; every pair of a band from the first and a band from the second is a table
key. So bands x bands tables of 2 x rows minima each cost only 2 x bands x rows minima per shingle: the
square root of what independent tables need, for the same choice of candidates.

Documents that share a key are candidates. Candidate groups are the connected components of "shares a key".
A group that doesn't fit one task is parted first: alike sets share one of their rarest shingles (the exact
prefix filter), so its parts are the components of "shares such a shingle", and pages of one template that
are not alike fall apart without being compared. Inside a part, documents are dealt into blocks of bounded
size, and every two blocks are compared in one task on full sets. There the prefix filter drops pairs that
can't be alike, and pairs already known to be connected are not compared again, so pairs are never listed.
What leaves a task are links that join parts; their components are the result. No link between documents
that share a key is lost.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendwork.session import materialise

from . import common
from .common import map_rows, split_by_ids, unused, utf8, worker_cache
from .components import components

common.ship(__name__)

WIDTH = 5
PERCENT = 85
BANDS = 9
ROWS = 3
BLOCK_DOCUMENTS = 1024
# A block's shingles per document that it may hold, on average.
BLOCK_SHINGLES = 2048
MEMO_WORDS = 300_000

SIGNATURES = "doc_id long, n_shingles long, class binary, first array<long>, second array<long>"


def _mix(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def shingles(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """The distinct 64-bit hashes of all runs of ``width`` words, sorted; all words as one run if there are fewer."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    memo = worker_cache("near-dedup-words")
    if len(memo) > MEMO_WORDS:
        memo.clear()
    for word in {w for w in words if w not in memo}:
        memo[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    hashes = np.fromiter((memo[w] for w in words), dtype=np.uint64, count=len(words))
    run = min(width, len(words))
    out = np.full(len(words) - run + 1, run, dtype=np.uint64)
    for i in range(run):
        with np.errstate(over="ignore"):
            out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(out)]
        out ^= out >> np.uint64(29)
    return np.unique(_mix(out))


def multipliers(count: int, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Parameters of the minima's hash functions: odd factors and offsets."""
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, count, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, count, dtype=np.uint64)


def half_keys(sets: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Hashes of the bands of both collections, 2 x bands numbers."""
    factors, offsets = multipliers(2 * bands * rows)
    with np.errstate(over="ignore"):
        minima = np.array([_top(sets * f + o) for f, o in zip(factors, offsets, strict=True)], dtype=np.uint64)
        keys = np.arange(2 * bands, dtype=np.uint64)
        for column in minima.reshape(2 * bands, rows).T:
            keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys


def _top(values: np.ndarray) -> np.uint64:
    return (values ^ (values >> np.uint64(32))).min()


def signatures(
    docs: DataFrame, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Set size, a hash of the word sequence and the half keys, for every row."""

    def work(lists: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": lists["doc_id"], "n_shingles": [], "class": [], "first": [], "second": []}
        for raw in lists["text"]:
            words = raw.lower().split()
            sets = shingles(words, width)
            out["n_shingles"].append(len(sets))
            out["class"].append(hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None)
            keys = half_keys(sets, bands, rows).view(np.int64).tolist() if words else []
            out["first"].append(keys[:bands])
            out["second"].append(keys[bands:])
        return out

    return map_rows(docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), utf8(text_column).alias("text")), work, SIGNATURES)


def table_keys(df: DataFrame, bands: int) -> DataFrame:
    """One row per table and document: a hash of a band of the first and a band of the second collection.

    A table key can only be shared where both its halves are. So the 2 x bands halves are matched first, and
    only those that occur in another document too are combined; a document without any has no rows.
    """
    halves = df.select("doc_id", F.posexplode(F.concat("first", "second")).alias("place", "half"))
    ends = halves.groupBy("half").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = halves.join(ends.where("low != high").select("half"), "half", "left_semi")
    mine = shared.groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("place") < bands, F.col("half"))).alias("first"),
        F.collect_list(F.when(F.col("place") >= bands, F.col("half"))).alias("second"),
    )
    return mine.select("doc_id", F.explode("first").alias("x"), "second").select(
        "doc_id", "x", F.explode("second").alias("y")
    ).select("doc_id", F.xxhash64("x", "y").alias("key"))


def linked(left: np.ndarray, sizes: np.ndarray, starts: np.ndarray, flat: np.ndarray, n_words: int, percent: int, home: np.ndarray):
    """Links that join parts, among documents given as rows of local shingle numbers (rarest first).

    ``left`` marks the documents of the first block; ``home`` says whether pairs within a block count too.
    """
    part = np.arange(len(sizes))
    links = []
    # Two alike sets share a shingle among the first size - ceil(least overlap) + 1 in any fixed order.
    prefix = sizes - (percent * sizes + 99) // 100 + 1
    index: dict[int, list[int]] = {}
    mask = np.zeros(n_words, dtype=bool)
    for x in np.argsort(sizes, kind="stable").tolist():
        own = flat[starts[x] : starts[x] + sizes[x]]
        firsts = own[: prefix[x]].tolist()
        seen = [index[w] for w in firsts if w in index]
        if seen:
            near = np.unique(np.concatenate([np.asarray(s) for s in seen])) if len(seen) > 1 else np.asarray(seen[0])
            near = near[(100 * sizes[near] >= percent * sizes[x]) & (part[near] != part[x]) & (home | (left[near] != left[x]))]
            if len(near):
                mask[own] = True
                for y, both in zip(near.tolist(), overlaps(near, starts, sizes, flat, mask).tolist(), strict=True):
                    if 100 * both >= percent * (sizes[x] + sizes[y] - both) and part[x] != part[y]:
                        links.append((x, y))
                        part[part == part[x]] = part[y]
                mask[own] = False
        for w in firsts:
            index.setdefault(w, []).append(x)
    return links


def overlaps(rows: np.ndarray, starts: np.ndarray, sizes: np.ndarray, flat: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """How many marked shingles each of the rows has; a bounded number of entries at a time."""
    out, begin = np.zeros(len(rows), dtype=np.int64), 0
    while begin < len(rows):
        total = np.cumsum(sizes[rows[begin:]])
        end = begin + max(1, int(np.searchsorted(total, 1 << 20)))
        some = rows[begin:end]
        first = np.cumsum(sizes[some]) - sizes[some]
        at = np.arange(int(sizes[some].sum())) + np.repeat(starts[some] - first, sizes[some])
        out[begin:end] = np.add.reduceat(mask[flat[at]].astype(np.int64), first)
        begin = end
    return out


def compare_blocks(doc_ids: list[int], texts: list[bytes], left: list[bool], home: bool, width: int, percent: int) -> list[tuple[int, int]]:
    """Confirmed links (larger, smaller id) among the documents of two blocks, enough to connect what is alike."""
    sets = [shingles(t.lower().split(), width) for t in texts]
    flat, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    # Numbers by how many documents have the shingle, so that a set's rarest shingles come first.
    rank = np.empty(len(counts), dtype=np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    flat = rank[flat]
    order = np.lexsort((flat, np.repeat(np.arange(len(sizes)), sizes)))
    found = linked(np.array(left), sizes, starts, flat[order], len(counts), percent, np.bool_(home))
    return [(max(doc_ids[x], doc_ids[y]), min(doc_ids[x], doc_ids[y])) for x, y in found]


def prefix_parts(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, component) of the documents that share a rare shingle with another one of their group.

    ``texts`` has doc_id, text (bytes) and component. Shingles are counted within a group; a set's prefix are
    its size - least overlap + 1 rarest ones. Two sets that are alike share a shingle of both prefixes, so
    they are in one part; a document without a row here is alike with no other. A shingle that only one
    text has is never moved again, and a shingle's texts are linked to its smallest id, not to each other.
    """

    def work(lists: dict[str, list]) -> dict[str, list]:
        words = [raw.lower().split() for raw in lists["text"]]
        return {
            "doc_id": lists["doc_id"],
            "component": lists["component"],
            "class": [hashlib.blake2b(b" ".join(w), digest_size=16).digest() for w in words],
            "shingles": [shingles(w, width).view(np.int64).tolist() for w in words],
        }

    sets = materialise(map_rows(texts, work, "doc_id long, component long, class binary, shingles array<long>"), "group-shingles")
    own = ["doc_id", "component", "class"]
    size = F.size("shingles")
    prefix = size - F.ceil(F.lit(percent) * size / 100).cast("int") + 1
    rows = sets.select(*own, size.alias("size"), prefix.alias("prefix"), F.explode("shingles").alias("shingle"))
    counts = rows.groupBy("component", "shingle").agg(F.count("*").alias("n")).where("n > 1")
    common_ones = rows.join(materialise(counts, "shingle-counts"), ["component", "shingle"])
    ordered = common_ones.groupBy(*own, "size", "prefix").agg(F.array_sort(F.collect_set(F.struct("n", "shingle"))).alias("s"))
    # The shingles that no other text has are the rarest and stand first in the prefix.
    room = F.greatest(F.lit(0), F.col("prefix") - (F.col("size") - F.size("s")))
    firsts = ordered.select("doc_id", "component", F.explode(F.slice("s", F.lit(1), room)).alias("f"))
    firsts = materialise(firsts.select("doc_id", "component", "f.shingle"), "prefix-shingles")
    hubs = firsts.groupBy("component", "shingle").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("top")).where("b != top").drop("top")
    return components(firsts.join(hubs, ["component", "shingle"]).select(F.col("doc_id").alias("a"), "b").where("a != b").distinct())


def near_groups(
    docs: DataFrame,
    width: int = WIDTH,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    block_documents: int = BLOCK_DOCUMENTS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents with 100 x common >= percent x united shingles are linked; ``component_id`` is the smallest id
    that is reachable. A text without words (or none) has no set and is linked with nothing. Rows that
    repeat an id are that document (they should hold its text; any of them links it). A row without an id
    is linked with nothing: ``component_id`` is null and it is kept. Other columns are ignored.
    """
    found = materialise(signatures(docs, width, bands, rows, id_column, text_column), "signatures")
    known = found.where("doc_id is not null and n_shingles > 0")

    # Equal word sequences are one class; its smallest id stands for it from here on.
    classes = known.groupBy("class").agg(F.min("doc_id").alias("rep"))
    members = materialise(known.select("doc_id", "class").distinct().join(classes, "class").select("doc_id", "rep", "class"), "classes")
    same = members.where("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    reps = members.where("doc_id = rep").select("doc_id", "class")

    distinct = known.join(reps, ["doc_id", "class"], "left_semi").dropDuplicates(["doc_id", "class"])
    keyed = materialise(table_keys(distinct, bands), "table-keys")
    hubs = keyed.groupBy("key").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("top")).where("b != top").drop("top")
    shared = keyed.join(hubs, "key").select(F.col("doc_id").alias("a"), "b").where("a != b").distinct()
    groups = materialise(components(shared), "candidate-groups")

    # Blocks are bounded by documents and by shingles, so a few very long texts do not fill a task.
    lengths = reps.join(known.groupBy("doc_id").agg(F.max("n_shingles").alias("n")), "doc_id").select(F.col("doc_id").alias("id"), "n")
    blocks = F.ceil(F.greatest(F.count("*") / block_documents, F.sum("n") / (block_documents * BLOCK_SHINGLES)))
    size_of = lambda parts: parts.join(lengths, "id").groupBy("component").agg(blocks.cast("int").alias("blocks"))
    texts = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), utf8(text_column).alias("text"))

    # Only groups of several blocks are parted: one block is compared in one task either way.
    sizes = materialise(size_of(groups), "group-sizes")
    wide = materialise(groups.join(sizes.where("blocks > 1"), "component", "left_semi"), "wide-groups")
    if not wide.isEmpty():
        maybe, _ = split_by_ids(texts, "doc_id", wide.select("id"))
        parts = prefix_parts(maybe.join(wide.withColumnRenamed("id", "doc_id"), "doc_id"), width, percent)
        narrow = groups.join(sizes.where("blocks = 1"), "component", "left_semi")
        groups = materialise(narrow.select("id", "component").union(parts.select("id", "component")), "parted-groups")
        sizes = materialise(size_of(groups), "part-sizes")

    dealt = groups.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    maybe, _ = split_by_ids(texts, "doc_id", groups.select("id"))
    placed = maybe.join(dealt.withColumnRenamed("id", "doc_id"), "doc_id")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = placed.select("doc_id", "text", "component", "block", "blocks", other).select(
        "doc_id", "text", "component", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )

    def compare(key, table):
        low, high = key[1].as_py(), key[2].as_py()
        # With two blocks, pairs within a block are left to the task that has this block alone.
        blocks = table.column("block").to_pylist()
        links = compare_blocks(
            table.column("doc_id").to_pylist(), table.column("text").to_pylist(), [b == low for b in blocks], low == high, width, percent
        )
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    links = pairs.groupBy("component", "low", "high").applyInArrow(compare, "a long, b long")
    result = components(links.union(same))
    out = found.select("doc_id", "n_shingles").join(result.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def recall(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    """The chance that two sets of this similarity share a table key."""
    return (1 - (1 - math.pow(similarity, rows)) ** bands) ** 2


# Keys of rows without an id begin here, so that a row with an id is kept rather than its copy without one.
NO_ID = 1 << 62


def row_key(id_column: str, text_column: str) -> Column:
    """A row's id; without one, a hash of its text from 2^62 on. Rows without an id and without words have none."""
    text = F.col(f"`{text_column}`").cast("string")
    hashed = F.xxhash64(text).bitwiseAND(F.lit(NO_ID - 1)).bitwiseOR(F.lit(NO_ID))
    return F.coalesce(F.col(f"`{id_column}`").cast("long"), F.when(text.rlike("[^\\x20\\x09-\\x0D]"), hashed))


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose document is kept, each once; same columns.

    Of the rows that repeat an id with the same text one stays (if other columns differ, the first one as
    JSON); rows of one id with different texts stay or go together. Rows without an id are documents by
    their text, and a near copy that has an id is kept in their place. Rows without an id and without words
    all stay: nothing tells them apart.
    """
    own = unused(docs, "row_key")
    keyed = docs.withColumn(own, row_key(id_column, text_column))
    mark = unused(keyed, "marked")
    groups = materialise(near_groups(keyed, id_column=own, text_column=text_column, **options), "near-groups")
    known = groups.where("doc_id is not null").groupBy(F.col("doc_id").alias(mark))
    marks = known.agg(F.bool_or("kept").alias("kept"), F.count("*").alias("rows")).where("not kept or rows > 1")
    marks = materialise(marks, "gone-or-repeated")
    maybe, others = split_by_ids(keyed, own, marks.select(mark))
    same = F.col(own) == F.col(mark)
    once = others.union(maybe.join(marks.select(mark), same, "left_anti"))
    repeated = maybe.join(marks.where("kept").select(mark), same, "left_semi")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    first = repeated.groupBy(own, F.col(f"`{text_column}`")).agg(F.min_by(row, F.to_json(row)).alias(mark))
    return once.drop(own).union(first.select(*(F.col(mark)[c].alias(c) for c in docs.columns)))
