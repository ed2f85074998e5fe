"""SimHash fingerprints and the search for all fingerprints within a Hamming radius.

A text's terms are its runs of ``width`` words (a shorter text is one term). Each term's hash votes for or
against every bit, with the weight 1 + ln(frequency); the signs of the sums are the fingerprint. For a
radius of r a fingerprint is cut into blocks; two fingerprints within r differ in at most r blocks, so they
agree in all others. Each table permutes one choice of agreeing blocks to the front and matches on them.
``within_radius`` lists what it finds; ``count_within`` counts it without listing pairs.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendwork.session import materialise

from . import common
from .common import map_rows, utf8, worker_cache

common.ship(__name__)

BITS = 128
WIDTH = 3
MEMO_WORDS = 300_000
RADIUS = 3
BLOCK_ROWS = 2048

# Odd multipliers from the fractional part of the golden ratio, one per position and hash word.
STEP = 0x9E3779B97F4A7C15


def _mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (multiply and shift, twice)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word, from a memo of bounded size."""
    memo = worker_cache("simhash-words")
    if len(memo) > MEMO_WORDS:
        memo.clear()
    missing = {w for w in words if w not in memo}
    for word in missing:
        memo[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return np.fromiter((memo[w] for w in words), dtype=np.uint64, count=len(words))


def term_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash per run of ``width`` neighbouring words; the whole sequence if there are fewer."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    terms = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            terms = _mix(terms + hashes[i : i + len(terms)] + np.uint64(STEP))
    return terms


def fingerprint(text: bytes, bits: int = BITS, width: int = WIDTH) -> bytes:
    """The fingerprint of a text's words (lower-cased A to Z); no words give all zeros."""
    terms = term_hashes(word_hashes(text.lower().split()), width)
    if not len(terms):
        return bytes(bits // 8)
    terms, counts = np.unique(terms, return_counts=True)
    weights = (1.0 + np.log(counts)).astype(np.float32)
    with np.errstate(over="ignore"):
        words = [_mix(terms + np.uint64((STEP * (k + 1)) & (1 << 64) - 1)) for k in range(bits // 64)]
    votes = [weights @ _signs(w) for w in words]
    return np.packbits(np.concatenate(votes) > 0).tobytes()


def _signs(values: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.float32) * 2 - 1


def likeness(left: bytes, right: bytes) -> float:
    """The cosine that the share of differing bits stands for, from 0 (unrelated) to 1 (equal)."""
    differ = (int.from_bytes(left, "big") ^ int.from_bytes(right, "big")).bit_count()
    return float(max(0.0, np.cos(np.pi * differ / (8 * len(left)))))


def fingerprints(
    docs: DataFrame, bits: int = BITS, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint in hexadecimal) for every row; a missing or empty text has all zeros."""

    def work(rows: dict[str, list]) -> dict[str, list]:
        return {"doc_id": rows["doc_id"], "fingerprint": [fingerprint(t, bits, width).hex() for t in rows["text"]]}

    return map_rows(
        docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), utf8(text_column).alias("text")),
        work,
        "doc_id long, fingerprint string",
    )


# ---- neighbours in the order of ids ----


def edited(text: str, following: str) -> str:
    """The text whose last quarter is replaced by as much of the start of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(doc_id, text: bytes, own: bytes, following: bytes, other: bytes, bits: int, width: int) -> tuple:
    chars = text.decode("utf-8")
    changed = edited(chars, following.decode("utf-8")).encode("utf-8")
    print_ = fingerprint(changed, bits, width)
    sha = hashlib.sha256(changed).hexdigest()
    return doc_id, len(chars), sha, own.hex(), print_.hex(), likeness(own, print_), likeness(own, other)


def compare_with_next(
    docs: DataFrame, bits: int = BITS, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Fingerprints of every text and of its edited text, which ends like the next document's start.

    Next is by ascending id (a missing id first, repeated ids by text); after the last comes the first. A
    missing text counts as empty. One document alone is its own next. An empty table gives no rows.

    Texts are moved once, by ranges of ids, and read in order. Only a range's first and last row leave it:
    they are written to the shared folder and meet by the number of their range.
    """
    source = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), utf8(text_column).alias("text"))
    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered = ordered.withColumn("part", F.spark_partition_id())
    schema = f"kind int, part int, text binary, {RESULT}"
    fields = common.arrow_schema(docs, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, out = None, []
        for batch in batches:
            for doc_id, text, part in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own = fingerprint(text, bits, width)
                if before is None:
                    out.append((1, part, text, doc_id, None, None, own.hex(), None, None, None))
                else:
                    out.append((0, part, None, *_compare(*before[:3], text, own, bits, width)))
                before = (doc_id, text, own, part)
                if len(out) >= 1000:
                    yield _batch(out, fields)
                    out = []
        if before is not None:
            out.append((2, before[3], before[1], before[0], None, None, before[2].hex(), None, None, None))
            yield _batch(out, fields)

    rows = materialise(ordered.mapInArrow(run, schema), "simhash")
    first = rows.where("kind = 1").select("part", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    last = rows.where("kind = 2").select("part", "doc_id", "text", "fingerprint")
    # The range that follows each range: as many rows as there are ranges, without texts.
    parts = [r.part for r in first.select("part").orderBy("part").collect()]
    follow = dict(zip(parts, parts[1:] + parts[:1], strict=True))
    if follow:
        pairs = docs.sparkSession.createDataFrame(list(follow.items()), "part int, next_part int")
        joined = last.join(pairs, "part").join(first.withColumnRenamed("part", "next_part"), "next_part")
    else:
        joined = last.join(first.withColumnRenamed("part", "next_part"), F.lit(False))

    names = [f.name for f in common.arrow_schema(docs, RESULT)]

    def finish(lists: dict[str, list]) -> dict[str, list]:
        made = [
            _compare(i, t, bytes.fromhex(p), n, bytes.fromhex(q), bits, width)
            for i, t, p, n, q in zip(*(lists[c] for c in ("doc_id", "text", "fingerprint", "next_text", "next_print")), strict=True)
        ]
        return {name: list(values) for name, values in zip(names, zip(*made, strict=True), strict=True)}

    borders = map_rows(joined.select("doc_id", "text", "fingerprint", "next_text", "next_print"), finish, RESULT)
    return rows.where("kind = 0").select(*borders.columns).unionByName(borders)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=f.type) for f, values in zip(schema, zip(*rows, strict=True), strict=True)], schema=schema
    )


# ---- search within a radius ----


def block_edges(bits: int, blocks: int) -> list[int]:
    """Where the blocks begin, in whole hexadecimal digits, and the end of the last one."""
    return [bits // 4 * i // blocks for i in range(blocks + 1)]


def block_tables(column: Column, bits: int, radius: int, agreeing: int = 1) -> Column:
    """One key per table: the table's number and the ``agreeing`` blocks that it puts to the front.

    With radius + agreeing blocks, any two fingerprints within the radius share a key.
    """
    blocks = radius + agreeing
    edges = block_edges(bits, blocks)
    part = [F.substring(column, edges[i] + 1, edges[i + 1] - edges[i]) for i in range(blocks)]
    return F.array(
        *(
            F.concat(F.lit(f"{number}:"), *(part[i] for i in choice))
            for number, choice in enumerate(itertools.combinations(range(blocks), agreeing))
        )
    )


def distance(left: Column, right: Column, bits: int) -> Column:
    """Differing bits of two hexadecimal fingerprints."""
    halves = []
    for start in range(0, bits // 4, 8):
        a, b = (F.conv(F.substring(c, start + 1, 8), 16, 10).cast("long") for c in (left, right))
        halves.append(F.bit_count(a.bitwiseXOR(b)))
    total = halves[0]
    for other in halves[1:]:
        total = total + other
    return total


def within_radius(
    queries: DataFrame, prints: DataFrame, radius: int = 3, bits: int = BITS, agreeing: int = 1
) -> DataFrame:
    """All (query, doc_id, distance) with a distance of at most ``radius``; exact, nothing is capped.

    Both sides have ``doc_id`` and ``fingerprint``; a query does not find its own id. Equal fingerprints
    are searched once: the tables hold distinct fingerprints, and the ids are joined afterwards, so a
    large group of copies is one entry. A null fingerprint or id takes no part.
    """
    prints = prints.where("doc_id is not null and fingerprint is not null").select("doc_id", "fingerprint").distinct()
    queries = queries.where("doc_id is not null and fingerprint is not null").select("doc_id", "fingerprint").distinct()

    def entries(df: DataFrame, name: str) -> DataFrame:
        keys = block_tables(F.col("fingerprint"), bits, radius, agreeing)
        return df.select("fingerprint").distinct().select(F.col("fingerprint").alias(name), F.explode(keys).alias("key"))

    found = (
        entries(queries, "left")
        .join(entries(prints, "right"), "key")
        .select("left", "right", distance(F.col("left"), F.col("right"), bits).alias("distance"))
        .where(F.col("distance") <= radius)
        .distinct()
    )
    return (
        found.join(queries.withColumnRenamed("doc_id", "query").withColumnRenamed("fingerprint", "left"), "left")
        .join(prints.withColumnRenamed("fingerprint", "right"), "right")
        .where("query != doc_id")
        .select("query", "doc_id", "distance")
    )


def table_masks(bits: int, radius: int, agreeing: int = 1) -> np.ndarray:
    """For each block table the bits that it matches on, as bytes."""
    blocks = radius + agreeing
    edges = block_edges(bits, blocks)
    masks = []
    for choice in itertools.combinations(range(blocks), agreeing):
        digits = np.zeros(bits // 4, dtype=np.uint8)
        for i in choice:
            digits[edges[i] : edges[i + 1]] = 15
        masks.append(digits[::2] << 4 | digits[1::2])
    return np.array(masks, dtype=np.uint8)


def count_in_block(prints: np.ndarray, weights: np.ndarray, left: np.ndarray, home: bool, table: int, masks: np.ndarray, radius: int) -> np.ndarray:
    """For each print (a row of bytes) the weight of the others within the radius that count in this table.

    A pair counts in the first table whose blocks agree; ``left`` marks the prints of the first block and
    ``home`` says whether pairs within a block count. A bounded number of prints at a time meets all.
    """
    words, masks = prints.view("<u8"), np.ascontiguousarray(masks).view("<u8")
    out = np.zeros(len(words), dtype=np.int64)
    for start in range(0, len(words), 256):
        some = slice(start, min(start + 256, len(words)))
        differ = [words[some, None, w] ^ words[None, :, w] for w in range(words.shape[1])]
        near = sum(np.bitwise_count(d).astype(np.int16) for d in differ) <= radius
        near &= (left[some, None] != left[None, :]) if not home else np.arange(len(words))[some, None] != np.arange(len(words))
        x, y = np.nonzero(near)
        if len(x):
            apart = words[some][x] ^ words[y]
            agree = np.array([((apart & m) == 0).all(axis=1) for m in masks[: table + 1]])
            counts = agree[table] & ~agree[:table].any(axis=0)
            np.add.at(out, x[counts] + start, weights[y[counts]])
    return out


def count_within(
    prints: DataFrame, radius: int = RADIUS, bits: int = BITS, agreeing: int = 1, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(fingerprint, n_near): how many other rows' fingerprints are within the radius; exact, nothing is capped.

    One row per fingerprint that has any; the rows with an equal fingerprint count too. ``prints`` has a column
    ``fingerprint`` (hexadecimal, ``bits`` a multiple of 64); a null takes no part. An empty table gives no rows.

    Equal fingerprints are one entry with a weight. Keys that a single fingerprint has are dropped before anything
    moves. A key of many is dealt into blocks, of which any two meet in one task; keys of few share a task. Pairs
    are counted where they are found, in the first table whose blocks agree.
    """
    weighed = prints.where("fingerprint is not null").groupBy("fingerprint").agg(F.count("*").alias("weight"))
    weighed = materialise(weighed, "prints")
    keyed = weighed.select("fingerprint", "weight", F.posexplode(block_tables(F.col("fingerprint"), bits, radius, agreeing)).alias("table", "block"))
    keyed = keyed.withColumn("key", F.xxhash64("block")).drop("block")
    shared = materialise(keyed.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1"), "block-keys")
    few = F.col("n") < block_rows
    entries = shared.where(few).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    place = F.when(few, F.pmod("key", F.lit(max(1, -(-entries // block_rows))))).otherwise(F.col("key"))
    split = F.when(few, 1).otherwise(F.ceil(F.col("n") / block_rows)).cast("int")
    placed = keyed.join(shared.select("table", "key", few.alias("few"), place.alias("place"), split.alias("split")), ["table", "key"])
    mine = F.pmod(F.xxhash64("fingerprint"), F.col("split")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("split") - 1))
    met = placed.select("fingerprint", "weight", "table", "few", "place", mine.alias("mine"), other.alias("other"))
    met = met.select(
        "fingerprint", "weight", "mine", "table", "few", "place", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high")
    )
    masks = table_masks(bits, radius, agreeing)

    def compare(key, rows):
        names = rows.column("fingerprint").to_pylist()
        values = np.frombuffer(bytes.fromhex("".join(names)), dtype=np.uint8).reshape(len(names), -1)
        table, low, high = key[0].as_py(), key[3].as_py(), key[4].as_py()
        left = rows.column("mine").to_numpy() == low
        gained = count_in_block(values, rows.column("weight").to_numpy(), left, low == high, table, masks, radius)
        at = np.nonzero(gained)[0]
        return pa.table({"fingerprint": pa.array([names[i] for i in at], pa.string()), "n_near": pa.array(gained[at], pa.int64())})

    gained = met.groupBy("table", "few", "place", "low", "high").applyInArrow(compare, "fingerprint string, n_near long")
    copies = weighed.where("weight > 1").select("fingerprint", (F.col("weight") - 1).alias("n_near"))
    return gained.union(copies).groupBy("fingerprint").agg(F.sum("n_near").alias("n_near"))


def with_near_count(rows: DataFrame, radius: int = RADIUS, bits: int = BITS) -> DataFrame:
    """``rows`` with a column n_near: other rows whose ``fingerprint`` is within the radius (0 for a null)."""
    found = materialise(count_within(rows.select("fingerprint"), radius, bits), "near-counts")
    return rows.join(found, "fingerprint", "left").select(*rows.columns, F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))
