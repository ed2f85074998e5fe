"""Packing and token counts against the tokenizers themselves."""

from __future__ import annotations

import os
import random
import sys
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from support import awkward_rows, frame

from mendwork.llm import packing, token_counts

ALPHABET = list("abZthe.,'<|>é́　ßİΣσς12 \n\t\x1c\x85​﻿漢▁ａ") + ["<|endoftext|>", "<s>", "   ", " the", "ing", "'LL"]


def random_texts(n: int) -> list[str]:
    rng = random.Random(5)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_word_ids_are_the_librarys():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = random_texts(3000) + ["The end. the END,", "", "क़ क़."]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(t, "<u2").tolist() for t in packing.tokenize([t.encode() for t in texts], path)]
    assert got == want


def test_word_memo_is_bounded_in_bytes(monkeypatch):
    from mendwork.llm.common import worker_cache

    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(packing, "MEMO_BYTES", 4000)
    worker_cache("packing-words").clear()
    worker_cache("packing-words-bytes").clear()
    texts = [" ".join(f"word{i}x{j}" * 5 for j in range(20)).encode() for i in range(40)]
    fresh = packing.tokenize(texts, path)
    for text in texts:
        packing.tokenize([text], path)
        held = sum(len(w) + len(i) for w, i in worker_cache("packing-words").items())
        assert held <= 4000 + len(text) * 3
    worker_cache("packing-words").clear()
    assert packing.tokenize(texts, path) == fresh


def test_window_is_the_fullest():
    rng = random.Random(3)
    for _ in range(200):
        lengths = [rng.randint(1, 40) for _ in range(rng.randint(1, 9))]
        counts = {n: lengths.count(n) for n in lengths}
        total, chosen = packing.fill_window(sorted(counts), dict(counts), 50)
        first = max(lengths)
        rest = list(lengths)
        rest.remove(first)
        sums = {0}
        for n in rest:
            sums |= {s + n for s in sums}
        assert total == first + max(s for s in sums if s <= 50 - first)
        assert total == sum(k * v for k, v in chosen.items())
        assert all(v <= counts[k] for k, v in chosen.items())


@pytest.mark.parametrize("lengths", [[], [0, 3], [2048], [4095] * 3, [1500] * 100, [7] * 5000, list(range(1, 900))])
def test_every_token_is_placed_once(lengths):
    sequences = packing.pack_lengths(lengths)
    places = defaultdict(list)
    for sequence in sequences:
        size = sum(n for _, _, n in sequence)
        assert size == 2048 or size & (size - 1) == 0
        for item, start, n in sequence:
            places[item].append((start, n))
    for item, length in enumerate(lengths):
        end = 0
        for start, n in sorted(places[item]):
            assert start == end and n > 0
            end += n
        assert end == length


def test_pack_on_awkward_rows(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    pieces = packing.pack(frame(spark).repartition(3), shard_documents=4).collect()
    want = defaultdict(list)
    for row in awkward_rows():
        ids = library.encode(row[1] or "", add_special_tokens=False).ids + [1]
        want[row[0]].append(ids)
    got = defaultdict(list)
    for p in pieces:
        got[p.doc_id].append(p)
    assert set(got) == set(want)
    for doc_id, several in want.items():
        assert sum(p.length for p in got[doc_id]) == sum(map(len, several))
        for p in got[doc_id]:
            whole = [ids for ids in several if len(ids) == p.doc_tokens]
            crcs = {zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) for ids in whole}
            assert p.ids_crc32 in crcs
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048


def test_equal_rows_are_dealt_over_shards(spark):
    rows = [(None, "the same text again", "en", "s", 1, "k", 1, "r", "f")] * 3000
    for parts in (1, 7):
        pieces = packing.pack(frame(spark, rows).repartition(parts), shard_documents=100).collect()
        tokens = pieces[0].doc_tokens
        assert sum(p.length for p in pieces) == 3000 * tokens
        by_shard = defaultdict(int)
        for p in pieces:
            by_shard[p.sequence_id >> 32] += p.length / tokens
        assert len(by_shard) == 30 and max(by_shard.values()) < 250
    # Shards are bounded by bytes of text too.
    pieces = packing.pack(frame(spark, rows), shard_bytes=6000).collect()
    assert len({p.sequence_id >> 32 for p in pieces}) == 10


def test_prefix_counts_are_the_librarys():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, counter = sentencepiece.SentencePieceProcessor(model_file=path), token_counts.PrefixCounter(path)
    for text in [*random_texts(400), "", " ", "▁", "thethethethe" * 5, "a" * 70]:
        counts = counter.prefixes(text)
        assert counts.tolist() == [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        assert counter.count(text) == counts[-1]


def test_counts_and_budgets_on_awkward_rows(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = token_counts.count_tokens(frame(spark), budget=20, keep_prefixes=True).collect()
    want = sorted(((r[0] or -1), len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in awkward_rows())
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in rows) == want
    texts = {r[0]: r[1] or "" for r in awkward_rows() if r[0] is not None}
    for r in rows:
        assert r.over_limit == (r.n_tokens > 20)
        assert r.prefix_tokens[-1] == r.n_tokens
        if r.doc_id is not None and len(texts[r.doc_id]) < 500:
            fits = [i for i in range(len(texts[r.doc_id]) + 1) if len(library.encode(texts[r.doc_id][:i])) <= 20]
            assert r.budget_chars == fits[-1]


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert packing.pack(empty).count() == 0
    assert token_counts.count_tokens(empty).count() == 0
