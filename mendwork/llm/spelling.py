"""Groups of spelling variants by permuterm rotations.

A word's end is marked and all rotations of the marked word are formed. In ``B|A`` (the word is ``AB``, ``|`` is
the mark) the place between A and B stands at both ends. So of two words ``AxB`` and ``AyB``, that differ by one
replaced character, the rotations ``B|Ax`` and ``B|Ay`` agree in all but their last character; and the word
``AB``, that lacks it, has the rotation ``B|A`` itself. Sorted by this prefix, a word's neighbours at every place
stand side by side. The words of a prefix differ in one character, so there are at most as many as the alphabet
has letters, and one more: no group grows with the data.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendwork.session import materialise

from . import common
from .common import arrow_schema, utf8

common.ship(__name__)

LEAST_LENGTH = 6
LEAST_COUNT = 5
# A form has at least this many times the occurrences of its variant.
RATIO = 5
# Ends a word in its rotations: words are runs of letters, so none contains it.
MARK = "\x00"
# Distinct words that a task counts before it hands them on: bounds its memory, not the result.
HELD_WORDS = 200_000

# Latin-1 bytes: letters stay, A-Z become small, everything else parts words.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def words(raw: bytes) -> list[bytes]:
    """The runs of ``[A-Za-z\\u00C0-\\u00FF]`` in a UTF-8 text, as Latin-1 bytes with A-Z made small.

    A character beyond U+00FF becomes one byte that is no letter.
    """
    return raw.decode("utf-8", "replace").encode("latin-1", "replace").translate(_LETTERS).split()


def with_slips(counts: Counter[bytes], prefix: bytes, every: int) -> Iterator[tuple[bytes, int]]:
    """Words of one document; where ``every`` divides the crc32 of prefix and word, one letter is left out."""
    begun = zlib.crc32(prefix)
    for word, n in counts.items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), begun)
        if h % every == 0:
            place = h % len(word)
            word = word[:place] + word[place + 1 :]
        yield word, n


def word_counts(docs: DataFrame, slip_every: int | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n): every word of all texts and how often it occurs.

    Words are runs of Latin letters, A-Z made small. With ``slip_every`` a letter is left out of the words whose
    checksum with the document's id it divides: a repeatable way to put slips into a corpus. Counted by task
    first, so a frequent word is a few rows in the shuffle. A missing text has no words, a missing id counts as
    an empty one, and rows that repeat are counted each time.
    """
    rows = docs.select(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("doc_id"), utf8(text_column).alias("text"))
    target = arrow_schema(docs, "word string, n long")

    def handed_on(held: Counter[bytes]) -> pa.RecordBatch:
        names = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([names, pa.array(list(held.values()), pa.int64())], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = Counter(words(text.as_py()))
                if slip_every:
                    for word, n in with_slips(counts, f"{doc_id}:".encode(), slip_every):
                        held[word] += n
                else:
                    held.update(counts)
                if len(held) > HELD_WORDS:
                    yield handed_on(held)
                    held.clear()
        yield handed_on(held)

    counted = rows.mapInArrow(run, "word string, n long")
    return counted.where("word != ''").groupBy("word").agg(F.sum("n").alias("n"))


def rotations(vocabulary: DataFrame) -> DataFrame:
    """(prefix, edited, first, word, n): every place where a word of (word, n) may have been edited.

    ``edited`` is the character that the prefix skips, or empty for the word that has none there. ``first`` marks
    the first of equal characters in a row: leaving out any of them gives the same word, which is to be met once.
    """
    w, i = F.col("word"), F.col("i")
    before, after = F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.char_length(w))
    places = vocabulary.select("word", "n", F.explode(F.sequence(F.lit(1), F.char_length(w) + 1)).alias("i"))
    edited = F.substring(w, i, F.lit(1))
    skipped = F.struct(
        F.concat(after, F.lit(MARK), before).alias("prefix"),
        edited.alias("edited"),
        ((i == 1) | (F.substring(w, i - 1, F.lit(1)) != edited)).alias("first"),
    )
    whole = F.struct(
        F.concat(F.substring(w, i, F.char_length(w)), F.lit(MARK), before).alias("prefix"), F.lit("").alias("edited"), F.lit(True).alias("first")
    )
    # At the place behind the last character there is nothing to skip.
    both = F.when(i <= F.char_length(w), F.array(skipped, whole)).otherwise(F.array(whole))
    return places.select("word", "n", F.explode(both).alias("r")).select("r.prefix", "r.edited", "r.first", "word", "n")


def _pairs(table: pa.Table) -> dict[str, list]:
    """All neighbours among the rows of whole prefixes, sorted by prefix."""
    out: dict[str, list] = {"word": [], "n": [], "near": [], "near_n": []}
    if table.num_rows < 2:
        return out
    prefix = table.column("prefix").combine_chunks()
    same = pc.equal(prefix.slice(1), prefix.slice(0, len(prefix) - 1)).to_numpy(zero_copy_only=False)
    starts = [i for i in same.nonzero()[0].tolist() if i == 0 or not same[i - 1]]
    if not starts:
        return out
    edited, first, word, n = (table.column(c).to_pylist() for c in ("edited", "first", "word", "n"))
    for begin in starts:
        end = begin + 1
        while end <= len(same) and same[end - 1]:
            end += 1
        for x in range(begin, end):
            for y in range(begin, end):
                # Two edited words differ by a replaced character; of an edited and a whole one the former has one more.
                if x != y and (first[x] and first[y] if not edited[x] or not edited[y] else True):
                    out["word"].append(word[x])
                    out["n"].append(n[x])
                    out["near"].append(word[y])
                    out["near_n"].append(n[y])
    return out


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every two words of (word, n) with exactly one inserted, deleted or replaced character.

    Each pair is there once in either direction. Words must be distinct and free of the mark.
    """
    schema = "word string, n long, near string, near_n long"
    target = arrow_schema(vocabulary, schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None

        def found(table: pa.Table) -> pa.RecordBatch:
            out = _pairs(table)
            return pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in target], schema=target)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([kept, table]) if kept is not None else table
            # The last prefix may go on in the next batch.
            prefix = table.column("prefix")
            end = table.num_rows
            last = prefix[end - 1] if end else None
            while end and prefix[end - 1] == last:
                end -= 1
            if end:
                yield found(table.slice(0, end))
            kept = table.slice(end)
        if kept is not None:
            yield found(kept)

    turned = rotations(vocabulary).repartition("prefix").sortWithinPartitions("prefix")
    return turned.mapInArrow(scan, schema)


def best_forms(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n) for every word; see ``variants``."""
    near = neighbours(vocabulary).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("below"), "near")).alias("best")
    )
    count: Column = -F.col("best.below")
    formed = vocabulary.join(near, "word", "left").withColumn("formed", count >= ratio * F.col("n"))
    return formed.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("formed"), F.col("best.near")).alias("form"),
        F.when(F.col("formed"), count).alias("form_n"),
    )


def variants(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every row of (word, n), words distinct.

    A word's form is its neighbour with the most occurrences (ties: the smallest in code-point order) if it has
    at least ``ratio`` times as many; the root is where the forms end. Paths are halved by joining the table of
    forms with itself, and as each form is ``ratio`` times as frequent as the word before, a few rounds do.
    With a ratio of 1 or less, words of one count could name each other: refused. An empty table gives no rows.
    """
    if ratio <= 1:
        raise ValueError("the ratio has to be more than 1")
    formed = materialise(best_forms(vocabulary, ratio), "forms")
    steps = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = materialise(
            steps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots"
        )
        if not steps.where("moved").take(1):
            break
        steps = steps.drop("moved")
    return formed.join(steps.drop("moved"), "word", "left").select(*formed.columns, F.coalesce("root", "word").alias("root"))


def spelling_variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    slip_every: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The variants among the words of all texts that are long and frequent enough; see ``word_counts`` and ``variants``.

    Documents without text or words add nothing; an empty table gives no rows; other columns are ignored.
    """
    counted = word_counts(docs, slip_every, id_column, text_column)
    vocabulary = materialise(counted.where((F.char_length("word") >= least_length) & (F.col("n") >= least_count)), "vocabulary")
    return variants(vocabulary, ratio)
