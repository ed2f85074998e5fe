"""Packing token sequences by minimum bin slack.

Documents are tokenised, whole windows of ``capacity`` ids become sequences of their own, and the
remainders are packed by a bitset subset-sum: for each window the multiset of remaining lengths that
comes closest to the capacity is chosen, and its counts are traced back through the bitsets. Only when
no multiset fills a window, the largest remaining piece is cut to fill it.

Documents are spread over shards by a hash of their id. A shard is packed in one task; its size is a
parameter and does not grow with the data, so one source or one group of copies spreads over all shards.
"""

from __future__ import annotations

import sys
import unicodedata
import zlib
from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import utf8, worker_cache

common.ship(__name__)

CAPACITY = 2048
END_ID = 1
# A shard has about so many documents, and so many bytes of text, at most.
SHARD_DOCUMENTS = 2048
SHARD_BYTES = 32 << 20
MEMO_WORDS = 400_000
# Bytes the word memo may hold: its words, their ids and what a dictionary entry costs besides.
MEMO_BYTES = 16 << 20
ENTRY_BYTES = 100
SEPARATOR = "<|endoftext|>"

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_length long"
)


def _encoder(path: str):
    memo = worker_cache("packing-tokenizer")
    if path not in memo:
        from tokenizers import Tokenizer

        memo[path] = Tokenizer.from_file(path)
    return memo[path]


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 16-bit numbers."""
    packed = array("H", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _word_ends(path: str) -> np.ndarray:
    """Per id whether it ends a run of letters."""
    memo = worker_cache("packing-word-ends")
    if path not in memo:
        vocabulary = _encoder(path).get_vocab()
        memo[path] = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        memo[path][[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
    return memo[path]


def encode_words(words: list[bytes], path: str, memo: dict) -> None:
    """Put the ids (unsigned 16-bit) of the words that ``memo`` lacks into it.

    White space separates words for this vocabulary, so a word's ids do not depend on its neighbours. Small
    ASCII letters are what the library's model sees as they are; other words of letters go to the library in
    texts of some words, each of which ends with a word-end piece; the rest is parted by a special token.
    """
    library = _encoder(path)
    model, part, ends = library.model, library.token_to_id(SEPARATOR), _word_ends(path)
    lettered, others = [], []
    for word in words:
        if word.isalpha() and word.islower():
            memo[word] = _packed([t.id for t in model.tokenize(word.decode("ascii"))])
        elif b"<|" in word:
            ids = library.encode(word.decode("utf-8"), add_special_tokens=False).ids
            memo[word] = _packed(ids)
        else:
            (lettered if letters_only(word) else others).append(word)
    for group, glue, is_end in ((lettered, " ", ends.__getitem__), (others, SEPARATOR, lambda ids: ids == part)):
        for at in range(0, len(group), 50):
            some = group[at : at + 50]
            text = glue.join([w.decode("utf-8") for w in some]) + (SEPARATOR if glue == SEPARATOR else "")
            ids = np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u2")
            raw, begin = ids.tobytes(), 0
            for word, end in zip(some, np.flatnonzero(is_end(ids)).tolist(), strict=True):
                # A separator is left out, a word's own last piece is not.
                stop = end if glue == SEPARATOR else end + 1
                memo[word] = raw[2 * begin : 2 * stop]
                begin = end + 1


def letters_only(word: bytes) -> bool:
    """Whether the library's normal form has letters alone, so that a stop after it is a piece of its own."""
    return word.isalpha() or unicodedata.normalize("NFC", word.decode("utf-8")).lower().isalpha()


def tokenize(texts: list[bytes], path: str) -> list[bytes]:
    """Each text's ids as little-endian unsigned 16-bit numbers.

    Words are kept in a memo bounded in words and in bytes; letters A to Z are lower-cased first (the
    library does the same) unless the text may hold a special token.
    """
    memo, held = worker_cache("packing-words"), worker_cache("packing-words-bytes")
    if len(memo) > MEMO_WORDS or held.get("bytes", 0) > MEMO_BYTES:
        memo.clear()
        held["bytes"] = 0
    out = []
    for text in texts:
        # Spaces beyond ASCII part words as well, but a word may hold them: the library sees it whole.
        words = (text if b"<|" in text else text.lower()).split()
        missing = {w for w in words if w not in memo}
        if missing:
            ended = {w for w in missing if w.endswith((b".", b",")) and letters_only(w[:-1])}
            alone = (missing - ended) | {w[:-1] for w in ended} | {b".", b","}
            encode_words([w for w in alone if w not in memo], path, memo)
            for w in ended:
                memo[w] = memo[w[:-1]] + memo[w[-1:]]
            held["bytes"] = held.get("bytes", 0) + sum(len(w) + len(memo[w]) + ENTRY_BYTES for w in missing | alone)
        out.append(b"".join([memo[w] for w in words]))
    return out


def fill_window(lengths: list[int], counts: dict[int, int], capacity: int) -> tuple[int, dict[int, int]]:
    """The reachable total closest to ``capacity`` and how many of each length it takes.

    ``lengths`` is sorted and without repeats, all counts are positive. The largest length starts the
    window; bit t of the bitset says that the others can add up to t. Lengths enter from the largest
    down and each step's bitset is kept, so that the counts can be traced back.
    """
    first = lengths[-1]
    room = capacity - first
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for at in range(bisect_right(lengths, room) - 1, -1, -1):
        length = lengths[at]
        most = min(counts[length] - (length == first), room // length)
        taken = 1
        while most > 0:
            taken = min(taken, most)
            grown = (reach | reach << (length * taken)) & mask
            if grown != reach:
                steps.append((length, taken, reach))
                reach = grown
            most -= taken
            taken *= 2
        if reach >> room & 1:
            break
    best = total = reach.bit_length() - 1
    chosen = {first: 1}
    for length, taken, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + taken
            total -= length * taken
    return first + best, chosen


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (item, start in the item, length); every item is placed completely.

    Items longer than the capacity give whole windows first. The last, partly filled window is cut
    into parts whose lengths are powers of two, which need no padding. Lengths of 0 take no part.
    """
    sequences: list[list[tuple[int, int, int]]] = []
    waiting: dict[int, list[tuple[int, int]]] = {}
    for item, length in enumerate(lengths):
        whole = length // capacity
        sequences += [[(item, i * capacity, capacity)] for i in range(whole)]
        if length % capacity:
            waiting.setdefault(length % capacity, []).append((item, whole * capacity))
    counts = {length: len(items) for length, items in waiting.items()}
    order = sorted(counts)

    def take(length: int) -> tuple[int, int]:
        item = waiting[length].pop()
        counts[length] -= 1
        if not counts[length]:
            del counts[length]
            order.pop(bisect_right(order, length) - 1)
        return item

    while order:
        total, chosen = fill_window(order, counts, capacity)
        window = []
        for length, n in chosen.items():
            for _ in range(n):
                item, start = take(length)
                window.append((item, start, length))
        if total < capacity and order:
            length = order[-1]
            item, start = take(length)
            # The window was the fullest there is, so this piece is longer than the gap.
            gap = capacity - total
            window.append((item, start, gap))
            rest = length - gap
            if rest not in counts:
                counts[rest] = 0
                waiting[rest] = []
                order.insert(bisect_right(order, rest), rest)
            counts[rest] += 1
            waiting[rest].append((item, start + gap))
        if sum(n for _, _, n in window) == capacity:
            sequences.append(window)
        else:
            sequences += powers_of_two(window)
    return sequences


def powers_of_two(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Cut a window into sequences whose lengths are the powers of two of its own length."""
    total = sum(n for _, _, n in window)
    parts, pieces = [], list(reversed(window))
    for bit in range(total.bit_length() - 1, -1, -1):
        room = total & 1 << bit
        part = []
        while room:
            item, start, length = pieces.pop()
            used = min(room, length)
            part.append((item, start, used))
            if used < length:
                pieces.append((item, start + used, length - used))
            room -= used
        if part:
            parts.append(part)
    return parts


def pack(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    shard_documents: int = SHARD_DOCUMENTS,
    shard_bytes: int = SHARD_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pack whole documents into sequences; one row per piece.

    A document is its ids followed by ``end_id``; a missing or empty text is that id alone. Every row is
    packed for itself, repeated rows too; they are dealt over all shards. A row without an id is packed
    under a null ``doc_id``. An empty table gives no rows. Other columns are ignored.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), utf8(text_column).alias("text"))
    size = rows.agg(F.count("*").alias("documents"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    shards = max(1, -(-size.documents // shard_documents), -(-size.bytes // shard_bytes))

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        end = np.array([end_id], dtype="<u2").tobytes()
        # How often a task has met a row; equal rows are told apart by it whatever their order.
        met: Counter[int] = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, common.SLICE):
                some = batch.slice(at, common.SLICE)
                doc_id, text, row, task = (some.column(n) for n in ("doc_id", "text", "row", "task"))
                shard = []
                for key, number in zip(row.to_pylist(), task.to_pylist(), strict=True):
                    shard.append(deal(key, number, met[key], shards))
                    met[key] += 1
                ids = [t + end for t in tokenize(text.to_pylist(), path)]
                columns = [doc_id, pa.array(shard, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "shard", "ids"])

    keyed = rows.withColumn("row", F.xxhash64("doc_id", "text")).withColumn("task", F.spark_partition_id())
    ids = keyed.mapInArrow(encode, "doc_id long, shard long, ids binary")

    def pack_shard(key, table):
        import pyarrow as pa

        doc_ids, raw = table.column("doc_id").to_pylist(), table.column("ids").to_pylist()
        order = sorted(range(len(raw)), key=lambda i: (doc_ids[i] is None, doc_ids[i] or 0, raw[i]))
        sequences = pack_lengths([len(raw[i]) // 2 for i in order], capacity)
        out: dict[str, list] = {n: [] for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length")}
        for number, sequence in enumerate(sequences):
            offset = 0
            for item, start, length in sequence:
                source = raw[order[item]]
                piece = np.frombuffer(source, dtype="<u2", count=length, offset=2 * start).astype("<u4")
                out["doc_id"].append(doc_ids[order[item]])
                out["start"].append(start)
                out["length"].append(length)
                out["ids_crc32"].append(zlib.crc32(piece.tobytes()))
                out["doc_tokens"].append(len(source) // 2)
                out["sequence_id"].append((key[0].as_py() << 32) + number)
                out["offset"].append(offset)
                out["sequence_length"].append(sum(p[2] for p in sequence))
                offset += length
        return pa.table({k: pa.array(v, type=pa.int64()) for k, v in out.items()})

    return ids.groupBy("shard").applyInArrow(pack_shard, PIECES)


def deal(row: int, task: int, met: int, shards: int) -> int:
    """The shard of a row: by its hash, its task, and how many equal rows the task has met before.

    A repeated task has the same rows, so it deals the same rows to the same shards in whatever order.
    """
    return zlib.crc32(np.array([row, task, met], dtype="<i8").tobytes()) % shards
