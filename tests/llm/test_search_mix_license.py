"""Vector search, mixing, licences and the pipeline against plain versions."""

from __future__ import annotations

import hashlib
import io
import os
import random
import re
import sys
from collections import defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from support import awkward_rows, documents, frame

from mendwork.llm import licenses, mixing, near_dedup, packing, secrets, vantage
from mendwork.llm.queries import EPOCHS, SEED, WEIGHTS

# ---- vectors ----


def brute_nearest(rows, every, k):
    out = set()
    points = {i: np.array(v, dtype=float) for i, v in rows}
    for q in points:
        if q % every == 0:
            far = sorted((float(vantage.distances(points[q][None], points[i][None])[0, 0]), i) for i in points if i != q)
            out |= {(q, n, i, d) for n, (d, i) in enumerate(far[:k], 1)}
    return out


@pytest.mark.parametrize("hot", [0, 60])
def test_exact_search(spark, hot):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(300)]
    rows[:hot] = [(i, [0.5] * 8) for i in range(hot)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vantage.nearest_neighbours(vectors.repartition(3), every=10, k=5, shard_vectors=64).collect()
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in found}
    assert got == brute_nearest(rows, 10, 5)


def grouped_points(groups: int, each: int, dim: int) -> np.ndarray:
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(groups, dim)) * 6
    return np.concatenate([c + rng.normal(size=(each, dim)) * 0.5 for c in centres])


def test_whole_shards_are_left_out(spark):
    rows = [(i, p.tolist()) for i, p in enumerate(grouped_points(12, 80, 6))]
    vectors = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    index = vantage.build_index(vectors, shard_vectors=80)
    shards = index.trees.count()
    queries = vectors.where("vec_id % 20 = 0")
    found = vantage.search(index, queries, 5).collect()
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in found} == brute_nearest(rows, 20, 5)
    # With the distance to the fifth nearest known, most shards cannot hold anything closer.
    fifth = {r.query_id: r.score for r in found if r["rank"] == 5}
    bounds = spark.createDataFrame(list(fifth.items()), "query_id long, tau double")
    met = vantage.other_shards(index, queries.withColumnRenamed("vec_id", "query_id").join(bounds, "query_id"))
    assert shards >= 12 and met.count() < 0.4 * shards * len(fifth)


def test_relaxed_search_of_shards(spark):
    rows = [(i, p.tolist()) for i, p in enumerate(grouped_points(10, 60, 6))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {(q, i) for q, _, i, _ in brute_nearest(rows, 20, 5)}
    found = vantage.nearest_neighbours(vectors, every=20, k=5, factor=1.5, shard_vectors=40).collect()
    assert len({(r.query_id, r.vec_id) for r in found} & want) >= 0.9 * len(want)


def test_a_third_of_the_vectors_equal_and_several_dimensions(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(150)] + [(i, rng.normal(size=3).tolist()) for i in range(150, 400)]
    rows += [(i, rng.normal(size=2 + i % 3 * 2).tolist()) for i in range(400, 460)]
    vectors = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    # A sample of 20 lacks dimensions; shards stay small although one point is a third of all.
    index = vantage.build_index(vectors, shard_vectors=32, sample=20)
    sizes = [len(np.load(io.BytesIO(r.tree))["ids"]) for r in index.trees.collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 64
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in vantage.search(index, vectors.where("vec_id % 10 = 0"), 6, query_block=4).collect()}
    want = set()
    for dim in {len(v) for _, v in rows}:
        want |= brute_nearest([r for r in rows if len(r[1]) == dim], 10, 6)
    assert got == want


def test_relaxed_search_keeps_most():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 6)) * 5
    points = centres[rng.integers(30, size=3000)] + rng.normal(size=(3000, 6))
    ids, tree = np.arange(3000), vantage.build_tree(points)
    exact, _ = vantage.search_tree(tree, points, ids, points[:50], ids[:50], 10, 1.0)
    loose, _ = vantage.search_tree(tree, points, ids, points[:50], ids[:50], 10, 1.5)
    share = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(exact.tolist(), loose.tolist(), strict=True)])
    assert 0.7 < share <= 1


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (2, None, 1), (3, [], 1), (4, [0.0, 0.0], 1), (5, [1.0, None], 1), (6, [nan, 1.0], 1),
            (7, [inf, 1.0], 1), (None, [1.0, 2.0], 1), (1, [1.0, 1.0], 1), (100, [1.0, 0.0], 1), (8, [1.0, 2.0, 3.0], 1), (200, [-inf, 0.0], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, shard int")
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in vantage.nearest_neighbours(vectors).collect()}
    assert got == {(0, 1, 100, 0.0), (0, 2, 1, 1.0), (100, 1, 0, 0.0), (100, 2, 1, 1.0)}
    assert vantage.nearest_neighbours(vectors.limit(0)).count() == 0


# ---- mixing ----


def brute_mix(rows, weights, budget, max_epochs, seed):
    words, leaves = re.compile(r"[^\x20\x09-\x0D]+"), defaultdict(list)
    for doc_id, text, lang, source in rows:
        number = re.search(r"([0-9]{1,9})$", source or "")
        domain = f"domain{int(number[1]) % 4}" if number else "unknown"
        leaves[domain, lang or "unknown", source or "unknown"].append((doc_id, len(words.findall(text or ""))))
    amounts = {}

    def share_out(path, amount):
        if len(path) == 3:
            amounts[path] = amount
            return
        kids = sorted({leaf[: len(path) + 1] for leaf in leaves if leaf[: len(path)] == path})
        weight = {k: weights.get(mixing.LEVELS[len(path)], {}).get(k[-1], 1) for k in kids}
        room = {k: max_epochs * sum(n for leaf in leaves if leaf[: len(k)] == k for _, n in leaves[leaf]) for k in kids}
        kids = [k for k in kids if weight[k] > 0]
        got, free, left = {}, set(kids), amount
        while full := [k for k in free if room[k] * sum(weight[f] for f in free) <= weight[k] * left]:
            for k in full:
                got[k] = room[k]
                free.discard(k)
            left = amount - sum(got.values())
        for k in free:
            got[k] = weight[k] * left // sum(weight[f] for f in free)
        for k in kids:
            share_out(k, got[k])

    share_out((), budget)
    out = []
    for leaf, amount in amounts.items():
        members = leaves[leaf]
        total = sum(n for _, n in members)
        whole, rest = (amount // total, amount % total) if total else (1, 0)
        out += [(i, e) for e in range(whole) for i, _ in members]
        groups = defaultdict(list)
        for i, n in members:
            key = "|".join([str(seed), str(whole)] + ([str(i)] if i is not None else []))
            groups[hashlib.md5(key.encode()).hexdigest()].append((i, n))
        used = 0
        for key in sorted(groups):
            used += sum(n for _, n in groups[key])
            if used > rest or not rest:
                break
            out += [(i, whole) for i, _ in groups[key]]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("budget", "epochs", "weights"), [(None, 2, WEIGHTS), (500, 1, {}), (10**6, 3, {"language": {"fr": 0, "en": 5}}), (0, 1, {})])
def test_mix_like_the_plain_version(spark, budget, epochs, weights):
    rng = random.Random(6)
    rows = awkward_rows()
    for i in range(100, 400):
        rows.append((i, "w " * rng.randint(0, 30), rng.choice(["en", "fr", None]), rng.choice(["src0"] * 5 + ["src1", "src7", None]), 1, "k", 1, "r", "f"))
    docs = frame(spark, rows).repartition(4)
    got = mixing.mix(docs, weights=weights, budget=budget, max_epochs=epochs, seed=SEED)
    assert got.columns == [*docs.columns, *mixing.LEVELS, "epoch"]
    tokens = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows)
    want = brute_mix([r[:4] for r in rows], weights, tokens if budget is None else budget, epochs, SEED)
    assert sorted(((r.doc_id, r.epoch) for r in got.collect()), key=repr) == want


def test_shortage_goes_to_siblings_first(spark):
    # domain0 has two sources of which one is short; domain1 could hold everything.
    docs = documents(spark, ["w " * 10] * 60)
    docs = docs.selectExpr("doc_id", "text", "lang", "if(doc_id = 0, 'src0', if(doc_id < 30, 'src4', 'src1')) AS source")
    got = mixing.mix(docs, budget=400, max_epochs=1).groupBy("domain", "origin").count().collect()
    assert {(r.domain, r.origin): r["count"] for r in got} == {("domain0", "src0"): 1, ("domain0", "src4"): 19, ("domain1", "src1"): 20}


def test_weight_of_0_below_the_top_leaves_no_budget_unused(spark):
    # domain0 is nearly all French, which has weight 0; what it can't use goes to domain1.
    docs = documents(spark, ["w " * 10] * 60)
    docs = docs.selectExpr("doc_id", "text", "if(doc_id < 28, 'fr', 'en') AS lang", "if(doc_id < 30, 'src0', 'src1') AS source")
    got = mixing.mix(docs, weights={"language": {"fr": 0}}, budget=200, max_epochs=1).groupBy("domain", "language").count().collect()
    assert {(r.domain, r.language): r["count"] for r in got} == {("domain0", "en"): 2, ("domain1", "en"): 18}


def test_mix_of_nothing(spark):
    assert mixing.mix(frame(spark, [])).count() == 0


# ---- licences ----


def plain_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_phrases(text):
    words = plain_words(text)
    found = [(label, i) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(found, key=lambda p: (p[1], p[0]))


VOCABULARY = "cc by nc all rights reserved general public license the under licensed 4 0 gnu x GNU".split()


def test_matching_statistics():
    automaton, rng = licenses.Automaton(licenses.TEMPLATES, licenses.PHRASES), random.Random(2)
    sequences = [words for _, words in automaton.sequences] + [p.encode().split() for p in licenses.PHRASES]
    known = {tuple(automaton.ids[w] for w in s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, min(len(s), i + 14) + 1)}
    words = [w.encode() for w in VOCABULARY if w.encode() in automaton.ids]
    for _ in range(500):
        tokens = [automaton.ids[rng.choice(words)] for _ in range(12)]
        if rng.random() < 0.5:
            source = rng.choice(sequences)
            tokens[3:10] = [automaton.ids[w] for w in source[:7]]
        for i, (_, length) in enumerate(automaton.statistics(tokens)):
            assert length == max(n for n in range(i + 2) if n == 0 or tuple(tokens[i + 1 - n : i + 1]) in known)


def test_license_rows(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(VOCABULARY) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    texts += ["x Licensed under the Apache License, Version 2.0. y", "Licensed under CC BY-NC 4.0.", "All rights reserved.", "é CC\nBY"]
    texts.append("We say: " + licenses.TEMPLATES["mit"][2].replace("restriction", "limits") + " ok")
    for r in licenses.scan_licenses(documents(spark, texts)).collect():
        n, places = brute_phrases(texts[r.doc_id])
        assert r.n_words == n and [(p.label, p.start) for p in r.phrases] == places
    rows = {r.doc_id: r for r in licenses.scan_licenses(documents(spark, texts[400:])).collect()}
    assert [(s.label, s.start, s.words, s.coverage) for s in rows[0].spans] == [("apache-2.0", 1, 8, 1.0)]
    assert {s.label for s in rows[1].spans} >= {"cc-by-nc"} and [p.label for p in rows[1].phrases] == ["cc-by"]
    assert [s.label for s in rows[4].spans] == ["mit"] and 0.9 < rows[4].spans[0].coverage < 1


def test_license_on_awkward_rows(spark):
    rows = licenses.scan_licenses(frame(spark)).collect()
    assert sorted((r.doc_id or -1, r.n_words) for r in rows) == sorted((r[0] or -1, len(plain_words(r[1]))) for r in awkward_rows())
    assert licenses.scan_licenses(frame(spark, [])).count() == 0


def brute_best(template: list[str], text: list[str], min_match: int, gap: int) -> int:
    """The most words of the template that a chain of maximal common stretches covers."""
    found = []
    for i in range(len(text)):
        for j in range(len(template)):
            if text[i] == template[j] and not (i and j and text[i - 1] == template[j - 1]):
                n = 0
                while i + n < len(text) and j + n < len(template) and text[i + n] == template[j + n]:
                    n += 1
                if n >= min_match:
                    found.append((i, j, n))

    def best(last, total):
        most = total
        for i, j, n in found:
            over = max(0, last[0] + last[2] - i, last[1] + last[2] - j)
            if i > last[0] and j > last[1] and over < n and i + over - last[0] - last[2] <= gap:
                most = max(most, best((i, j, n), total + n - over))
        return most

    return max((best(f, f[2]) for f in found), default=0)


def scan_words(templates, text, min_match, coverage, gap, phrases=None):
    automaton = licenses.Automaton({k: [" ".join(v)] for k, v in templates.items()}, phrases or {})
    tokens = np.array([automaton.ids.get(w.encode(), -1) for w in text], dtype=np.int64)
    return automaton.scan(tokens, min_match, coverage, gap)


def test_spans_like_trying_all_chains():
    rng = random.Random(8)
    for round_ in range(400):
        alphabet = "abcd"[: rng.randrange(2, 5)] if round_ % 2 else "abcdefghijkl"
        templates = {label: [rng.choice(alphabet) for _ in range(rng.randrange(4, 10))] for label in ("one", "two")}
        text = []
        for _ in range(3):
            part = rng.choice(list(templates.values()))
            cut = rng.randrange(len(part))
            text += part[cut : cut + rng.randrange(1, 9)] + [rng.choice(alphabet + "z") for _ in range(rng.randrange(3))]
        for min_match, gap in ((2, 3), (3, 1)):
            _, spans = scan_words(templates, text, min_match, 0.01, gap)
            for label, words in templates.items():
                most = max((s[3] for s in spans if s[0] == label), default=0.0)
                assert most == min(1.0, brute_best(words, text, min_match, gap) / len(words))


def test_spans_with_stray_and_repeated_matches():
    letters = list("abcdefghijklmnop")
    # A stretch that returns in the template, and one that stands elsewhere in it.
    returning = [*letters[:8], *letters[2:4], *letters[8:12]]
    text = [*letters[:8], "zz", *letters[:4], "zz", *letters[8:12]]
    assert scan_words({"t": returning}, text, 2, 0.75, 12)[1]
    template = letters[:12]
    assert scan_words({"t": template}, [*letters[:8], "zz", *letters[:4], "zz", *letters[8:12]], 3, 0.99, 12)[1] == [("t", 0, 18, 1.0)]
    strayed = [*letters[:10], *letters[2:6], *letters[10:16]]
    assert scan_words({"t": letters}, strayed, 3, 0.99, 12)[1] == [("t", 0, 20, 1.0)]
    twice = [*letters, "zz", *letters]
    assert [s[1:3] for s in scan_words({"t": letters}, twice, 3, 0.9, 12)[1]] == [(0, 16), (17, 16)]


def test_phrases_of_one_word():
    places, _ = scan_words({"t": list("abcde")}, ["this", "is", "gpl", "code", "gpl"], 3, 0.75, 12, {"gpl": "gpl", "gpl code": "both"})
    assert sorted(places) == [("both", 2), ("gpl", 2), ("gpl", 4)]


# ---- pipeline and queries ----


def test_pipeline_like_its_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "secret_scan", "source_mixing", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    recognised = corpus_pipeline.language_id(spark, docs, folder)
    # Plain versions of what follows: the smallest id of each group, masked strings, the mix, all tokens.
    texts = {r.doc_id: r for r in recognised.collect()}
    assert len(texts) >= 0.97 * docs.count()
    groups = near_dedup.near_groups(recognised, percent=corpus_pipeline.NEAR_PERCENT, bands=corpus_pipeline.NEAR_BANDS).collect()
    texts = {r.doc_id: texts[r.doc_id] for r in groups if r.doc_id == r.component_id}
    kept = recognised.where(recognised.doc_id.isin(list(texts)))
    found = [r for r in secrets.scan(kept).collect() if r.predicted]
    clean = {i: r.text for i, r in texts.items()}
    for r in sorted(found, key=lambda r: -r.length):
        clean[r.doc_id] = clean[r.doc_id].replace(r.candidate, "[secret]")
    rows = [(i, clean[i], r.lang, r.source) for i, r in texts.items()]
    tokens = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in clean.values())
    mixed = brute_mix(rows, WEIGHTS, tokens, EPOCHS, SEED)
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    want = sorted((i, len(packing.tokenize([clean[i].encode()], path)[0]) // 2 + 1) for i, _ in mixed)
    pieces = corpus_pipeline.run(spark, folder).collect()
    got = defaultdict(int)
    for p in pieces:
        got[p.doc_id] += p.length
    total = defaultdict(int)
    for i, n in want:
        total[i] += n
    assert got == total


def test_pipeline_drops_near_copies_from_80_per_cent(spark):
    import corpus_pipeline
    from test_similar import brute_groups

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute_groups(rows, 80)
    # The table has pairs from 0.80 to below 0.85.
    assert len(set(want.values())) < len(set(brute_groups(rows, 85).values()))
    assert near_dedup.recall(0.80, bands=corpus_pipeline.NEAR_BANDS) > 0.999
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, folder).select("doc_id").collect()}
    assert kept == {i for i, _ in rows if want.get(i, i) == i}


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
