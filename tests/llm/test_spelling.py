"""Spelling variants against comparing all words with each other, and awkward rows."""

from __future__ import annotations

import os
import random
import re
import sys
import zlib
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from mendwork.llm import spelling
from support import awkward_rows, documents, frame

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts: dict[str, int], ratio: int) -> dict[str, tuple]:
    forms, near = {}, {w: [v for v in counts if one_edit(w, v)] for w in counts}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (counts[w], len(near[w]), forms[w], counts[forms[w]] if forms[w] else None, root)
    return out


def rows_of(df) -> dict[str, tuple]:
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def plain_counts(rows, slip_every=None) -> Counter:
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip_every and h % slip_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if run:
                counts[run] += 1
    return counts


@pytest.mark.parametrize("alphabet", ["ab", "aé÷z", "abcdefgh"])
def test_like_comparing_all_words(spark, alphabet):
    rng = random.Random(alphabet)
    found = {"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 7))): rng.choice([1, 2, 5, 5, 25, 130, 700]) for _ in range(250)}
    vocabulary = spark.createDataFrame(list(found.items()), "word string, n long")
    assert rows_of(spelling.variants(vocabulary)) == plain_variants(found, 5)


def test_chains_ties_and_runs_of_equal_letters(spark):
    # aaaa, aaa, aa, a: leaving out any letter gives the same neighbour, which counts once.
    counts = {"aaaa": 1, "aaa": 5, "aa": 25, "a": 125, "lone": 3, "tidy": 1, "tida": 5, "tide": 5}
    got = rows_of(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == plain_variants(counts, 5)
    assert got["aaaa"] == (1, 1, "aaa", 5, "a") and got["aaa"][1] == 2 and got["tidy"][2] == "tida"
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "word string, n long"), ratio=1)


def test_a_frequent_word_with_very_many_variants(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = "harbour"
    counts = {word: 10_000}
    for i in range(len(word)):
        counts.update({word[:i] + c + word[i + 1 :]: 7 for c in letters if c != word[i]} | {word[:i] + word[i + 1 :]: 6})
    got = rows_of(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(7)))
    assert got == plain_variants(counts, 5) and got[word][1] == len(counts) - 1


def test_words_and_slips(spark):
    texts = ["Été ÉTÉ été xĀy naïve×naïve ÷", "WORD word Wordy", None, "", "word " * 500, "漢字 mixed漢text"]
    rows = list(enumerate(texts))
    for every in (None, 1, 3):
        counted = spelling.word_counts(documents(spark, texts), every).collect()
        assert {r.word: r.n for r in counted} == plain_counts(rows, every)
    assert spelling.words("AéĀb\U0001f600c".encode()) == ["aé".encode("latin-1"), b"b", b"c"]


def test_on_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    want = {w: n for w, n in plain_counts(rows, 5).items() if len(w) >= 3 and n >= 2}
    got = spelling.spelling_variants(frame(spark), least_length=3, least_count=2, slip_every=5)
    assert rows_of(got) == plain_variants(want, 5)
    assert spelling.spelling_variants(frame(spark, [])).count() == 0
