"""Near-duplicate groups, SimHash and its search, against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))
from support import EN, awkward_rows, documents, frame, text

from mendwork.llm import near_dedup, simhash
from mendwork.llm.components import components


def brute_groups(rows, percent=85):
    sets = {}
    for i, t in rows:
        words = (t or "").encode().lower().split()
        if words and i is not None:
            sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def edits(base: str, seed: int, n: int) -> str:
    rng, words = random.Random(seed), base.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_groups_with_hot_copies(spark):
    base = text(1, EN, 120)
    texts = [edits(base, i, i % 5) for i in range(300)] + [base] * 40 + [text(100 + i, EN, 60) for i in range(60)]
    docs = documents(spark, texts).repartition(5)
    got = {r.doc_id: r for r in near_dedup.near_groups(docs, block_documents=32).collect()}
    want = brute_groups(list(enumerate(texts)))
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())
    kept = near_dedup.deduplicate(docs, block_documents=32)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(set(want.values()))


def test_groups_on_awkward_rows(spark):
    rows = near_dedup.near_groups(frame(spark)).collect()
    assert len(rows) == len(awkward_rows())
    want = brute_groups([r[:2] for r in awkward_rows()])
    for r in rows:
        assert r.component_id == want.get(r.doc_id, r.doc_id)
        assert r.kept == (r.component_id == r.doc_id)
        if r.doc_id in (3, 4, 5):
            assert r.n_shingles == 0
    kept = near_dedup.deduplicate(frame(spark)).collect()
    assert sorted(r.doc_id or -1 for r in kept) == [-1, -1, 1, 2, 3, 4, 5, 6, 7, 10, 11]
    assert near_dedup.near_groups(frame(spark, [])).count() == 0


def test_pages_of_one_template_are_parted(spark):
    frame_words = text(1, EN, 140).split()
    # Pages share a frame of 140 words (likeness about 0.5); every tenth page is a near copy of the one before.
    texts = []
    for i in range(400):
        own = text(500 + i, [f"v{i}x{k}" for k in range(30)], 45)
        texts.append(" ".join(frame_words) + " " + own if i % 10 else edits(texts[-1], i, 1) if texts else text(3, EN, 90))
    docs = documents(spark, texts).repartition(4)
    want = brute_groups(list(enumerate(texts)))
    got = near_dedup.near_groups(docs, block_documents=32).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    group = docs.selectExpr("doc_id", "cast(text as binary) as text", "0L as component")
    parts = {r.id: r.component for r in near_dedup.prefix_parts(group, 5, 85).collect()}
    alike = {i for i in want if sum(v == want[i] for v in want.values()) > 1}
    # What is linked shares a part; parts hold fewer than 20 other pages per page, though all share the frame.
    assert alike <= set(parts) and all(parts[i] == parts[want[i]] for i in alike)
    sizes = [sum(v == c for v in parts.values()) for c in parts.values()]
    assert max(sizes, default=0) < 20
    assert near_dedup.prefix_parts(group.limit(0), 5, 85).count() == 0


def test_deduplicate_repeats_and_rows_without_id(spark):
    base, other = text(5, EN, 80), text(6, EN, 80)
    rest = ("k", 1, "r", "f")
    rows = [(5, base, "en", "s", 1, *rest)] * 5 + [(None, other, "en", "s", 1, *rest)] * 4
    # A near copy without an id goes, the row with the id stays; one id with two texts keeps both.
    rows += [(None, base, "en", "s", 1, *rest), (20, text(7, EN, 80), "en", "b", 1, *rest), (20, text(8, EN, 80), "en", "a", 1, *rest)]
    # Repeated rows that differ elsewhere, rows without words, with an id and without.
    rows += [(30, text(9, EN, 60), "en", s, 1, *rest) for s in ("z", "y", "z")]
    rows += [(None, None, None, "s", None, *rest)] * 2 + [(None, " \t", None, "s", None, *rest)] * 2 + [(40, None, None, "s", None, *rest)] * 3
    docs = frame(spark, rows).repartition(4)
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text or "", r.source) for r in kept.collect())
    assert got == sorted(
        [(5, base, "s"), (0, other, "s"), (20, text(7, EN, 80), "b"), (20, text(8, EN, 80), "a"), (30, text(9, EN, 60), "y"), (40, "", "s")]
        + [(0, "", "s")] * 2 + [(0, " \t", "s")] * 2
    )
    assert near_dedup.deduplicate(frame(spark, [])).count() == 0


def test_shingles_of_short_texts():
    assert len(near_dedup.shingles([])) == 0
    assert len(near_dedup.shingles([b"a"])) == 1
    assert len(near_dedup.shingles([b"a", b"b", b"c", b"d", b"e"])) == 1
    assert near_dedup.shingles([b"a", b"b"]) != near_dedup.shingles([b"b", b"a"])
    assert near_dedup.recall(0.85) > 0.999


def test_components_of_long_paths(spark):
    path = [(i, i + 1) for i in range(100)] + [(200, 300), (7, 7), (None, 4)] + [(500, i) for i in range(501, 560)]
    links = spark.createDataFrame(path, "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {i: 0 for i in range(101)} | {200: 200, 300: 200} | {i: 500 for i in range(500, 560)}
    assert components(links.limit(0)).count() == 0


def test_fingerprint_votes():
    words = [b"a", b"b", b"a", b"b", b"a", b"c"]
    terms = simhash.term_hashes(simhash.word_hashes(words), 2)
    votes = np.zeros(64)
    for term, n in zip(*np.unique(terms, return_counts=True), strict=True):
        hashed = int(simhash._mix(np.array([term]) + np.uint64(simhash.STEP))[0])
        raw = hashed.to_bytes(8, "little")
        bits = np.unpackbits(np.frombuffer(raw, np.uint8)).astype(int)
        votes += (2 * bits - 1) * (1 + np.log(n))
    assert simhash.fingerprint(b" ".join(words), 64, 2) == np.packbits(votes > 0).tobytes()
    assert simhash.fingerprint(b"") == simhash.fingerprint(b" \n") == bytes(16)


def test_likeness_orders_edits():
    base = text(1, EN, 400)
    near = [simhash.likeness(simhash.fingerprint(base.encode()), simhash.fingerprint(edits(base, 2, n).encode())) for n in (0, 20, 200)]
    assert near[0] == 1 and near[0] > near[1] > near[2]


def test_compare_with_next(spark):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for i, (doc_id, own) in enumerate(order):
        own, following = own or "", order[(i + 1) % len(order)][1] or ""
        changed = simhash.edited(own, following).encode()
        prints = [simhash.fingerprint(t) for t in (own.encode(), changed, following.encode())]
        want.append(
            (doc_id, len(own), hashlib.sha256(changed).hexdigest(), prints[0].hex(), prints[1].hex(),
             simhash.likeness(prints[0], prints[1]), simhash.likeness(prints[0], prints[2]))
        )
    got = [tuple(r) for r in simhash.compare_with_next(frame(spark).repartition(5)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert simhash.compare_with_next(frame(spark, [])).count() == 0
    alone = simhash.compare_with_next(frame(spark, awkward_rows()[:1])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_search_within_radius(spark):
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(40)]
    for v in values[:20]:
        for _ in range(6):
            w = v
            for _ in range(rng.randint(0, 5)):
                w ^= 1 << rng.randrange(64)
            values.append(w)
    values += [values[0]] * 30
    rows = [(i, f"{v:016x}") for i, v in enumerate(values)]
    prints = spark.createDataFrame([*rows, (None, "0" * 16), (9999, None)], "doc_id long, fingerprint string")
    queries = prints.where("doc_id % 10 = 0")
    want = {(a, b, (values[a] ^ values[b]).bit_count()) for a in range(0, len(values), 10) for b in range(len(values)) if a != b and (values[a] ^ values[b]).bit_count() <= 3}
    for agreeing in (1, 2):
        found = simhash.within_radius(queries, prints, 3, 64, agreeing).collect()
        assert len(found) == len(want) and {tuple(r) for r in found} == want


def test_counts_within_radius(spark):
    rng = random.Random(8)
    values = [rng.getrandbits(128) for _ in range(60)]
    # One group of close prints that no block holds, small groups, copies, and the print of empty texts.
    for v, n in [(values[0], 200), *((v, 4) for v in values[1:30])]:
        for _ in range(n):
            w = v
            for _ in range(rng.randint(0, 4)):
                w ^= 1 << rng.randrange(128)
            values.append(w)
    values += [values[0]] * 50 + [0] * 20
    prints = spark.createDataFrame([(f"{v:032x}",) for v in values] + [(None,)], "fingerprint string").repartition(4)
    for radius, agreeing, block_rows in ((3, 1, 2048), (3, 1, 16), (2, 2, 16), (0, 1, 16)):
        want = {f"{v:032x}": sum((v ^ w).bit_count() <= radius for w in values) - 1 for v in values}
        got = {r.fingerprint: r.n_near for r in simhash.count_within(prints, radius, 128, agreeing, block_rows).collect()}
        assert got == {v: n for v, n in want.items() if n}
    marked = simhash.with_near_count(prints).collect()
    assert len(marked) == len(values) + 1 and all(r.n_near == 0 for r in marked if r.fingerprint is None)
    assert simhash.count_within(prints.limit(0)).count() == 0
    assert simhash.with_near_count(simhash.compare_with_next(frame(spark, []))).count() == 0
