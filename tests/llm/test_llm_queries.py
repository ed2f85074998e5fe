"""Every registered query on the smallest tables: against its SQL, or against a plain version."""

from __future__ import annotations

import hashlib
import os
import re
import sys
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from mendwork.llm import licenses, secrets, simhash
from mendwork.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall())


def run(spark, name):
    return QUERIES[name](spark, FOLDER)


@pytest.mark.parametrize("name", list(SQL))
def test_like_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = connection.execute(SQL[name])
    columns = [d[0] for d in result.description]
    want = sorted(result.fetchall(), key=repr)
    df = run(spark, name)
    assert sorted(df.columns) == sorted(columns)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == want


def test_packing(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in documents.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for p in run(spark, "op1_pack_sequences").collect():
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert p.doc_tokens == len(ids[p.doc_id]) and p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        pieces[p.doc_id].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts, size in [*((pieces[i], len(ids[i])) for i in ids), *((s, None) for s in sequences.values())]:
        end = 0
        for start, length in sorted(parts):
            assert start == end
            end += length
        assert end == size if size is not None else end == 2048 or end & (end - 1) == 0 and end < 2048


def test_secrets(spark, documents):
    places = set()
    for i, text in documents.items():
        for n, line in enumerate((text or "").split("\n")):
            for m in re.finditer(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}", line):
                if re.search(r"[0-9]|[a-z][A-Z]", m.group(0).rstrip("=")):
                    places.add((i, n, m.start(), m.group(0)))
    found = run(spark, "op2_secret_scan").collect()
    assert {(r.doc_id, r.line, r.start, r.candidate) for r in found} == places
    for r in found:
        before = documents[r.doc_id].split("\n")[r.line][: r.start]
        if re.search(r"(token|password)\s*=\s*\"?$", before) or re.match(secrets.FORMATS, r.candidate):
            assert r.predicted == 1
        elif r.candidate.isdigit():
            assert r.predicted == 0


def test_fingerprints(spark, documents):
    order = list(documents.items())
    rows = {r.doc_id: r for r in run(spark, "op3_simhash_fingerprints").collect()}
    assert len(rows) == len(order)
    values = {i: int(r.fingerprint, 16) for i, r in rows.items()}
    for n, (i, text) in enumerate(order):
        assert rows[i].n_near == sum((values[i] ^ v).bit_count() <= 3 for v in values.values()) - 1
        text, following = text or "", order[(n + 1) % len(order)][1] or ""
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        prints = [simhash.fingerprint(t.encode()) for t in (text, changed, following)]
        assert tuple(rows[i])[1:-1] == (
            len(text), hashlib.sha256(changed.encode()).hexdigest(), prints[0].hex(), prints[1].hex(),
            simhash.likeness(*prints[:2]), simhash.likeness(prints[0], prints[2]),
        )


@pytest.mark.parametrize(("name", "modulus", "remainder"), [("op4_quality_score", 3, 1), ("op7_language_id", 4, 2)])
def test_classifiers(spark, documents, name, modulus, remainder):
    rows = run(spark, name).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == remainder)
        assert 0 <= r.score <= 1
        if name.startswith("op4"):
            assert r.predicted == int(r.score >= 0.5)
        else:
            assert r.lang_pred in ("en", "fr", "de", "es", "und")
    if name.startswith("op7"):
        langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{FOLDER}/documents.parquet'").fetchall())
        held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
        assert np.mean(held) > 0.9


def test_token_counts(spark, documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in run(spark, "op8_token_counts").collect():
        text = documents[r.doc_id] or ""
        n = len(library.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 4096)
        assert (r.budget_chars == len(text)) or r.over_limit


def test_licenses(spark, documents):
    for r in run(spark, "op10_license_scan").collect():
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in documents[r.doc_id] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        labels = sorted({label for _, label in places})
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(places), ",".join(labels))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert set(labels) <= set(r.labels.split(",")) | ({""} if not r.labels else set())
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
