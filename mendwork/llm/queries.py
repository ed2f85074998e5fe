"""One query per operator, over whole tables, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    factorisation,
    hard_negatives,
    language,
    licenses,
    mixing,
    near_dedup,
    packing,
    secrets,
    simhash,
    spelling,
    token_counts,
    vantage,
    vector_dedup,
)
from .common import is_fold

WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "language": {"en": 4, "de": 2, "fr": 2, "es": 2},
}
EPOCHS = 2
SEED = 9
# In the query of spelling variants, words whose checksum it divides lose a letter.
SLIP_EVERY = 199


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


def op3_simhash_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.with_near_count(simhash.compare_with_next(table(spark, folder, "documents")))


def op4_quality_score(spark: SparkSession, folder: str) -> DataFrame:
    held_out = is_fold("doc_id", 3, 1)
    scored = factorisation.classify(table(spark, folder, "documents"), table(spark, folder, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, folder, "documents"))


def op6_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vantage.nearest_neighbours(table(spark, folder, "embeddings"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    held_out = is_fold("doc_id", 4, 2)
    found = language.identify(table(spark, folder, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, folder, "documents"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit", "budget_chars")


def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), weights=WEIGHTS, max_epochs=EPOCHS, seed=SEED)
    return mixed.select("doc_id", *mixing.LEVELS, "epoch")


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, folder, "documents"))
    base = F.col("phrases.label")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.start").alias("first_word"),
        F.array_max("phrases.start").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.col("spans.label"))).alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(F.array_max("spans.coverage"), F.lit(0.0))).alias("score"),
    )


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"), slip_every=SLIP_EVERY)


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved))


def op13_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.vector_groups(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pack_sequences,
        op2_secret_scan,
        op3_simhash_fingerprints,
        op4_quality_score,
        op5_near_duplicates,
        op6_nearest_vectors,
        op7_language_id,
        op8_token_counts,
        op9_source_mixing,
        op10_license_scan,
        op11_spelling_variants,
        op12_hard_negatives,
        op13_near_vectors,
    )
}


def _level(name: str, above: str, path: list[str], weight: str) -> str:
    """One level of the budget: nodes with capacities, then what each of them gets."""
    keys, parents = ", ".join(path), ", ".join(path[:-1])
    inside = f"PARTITION BY {parents}" if parents else ""
    budget = f"JOIN {above} USING ({parents})" if parents else f"CROSS JOIN {above}"
    return f"""
    {name}_nodes AS (
        SELECT n.*, b.budget FROM (
            SELECT {keys}, CAST(sum(tokens) * {EPOCHS} AS BIGINT) AS capacity, {weight} AS weight FROM docs GROUP BY {keys}
        ) n {budget.replace(above, above + ' b')}
    ), {name}_marked AS (
        SELECT *, capacity * CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT)
               <= weight * (budget - CAST(coalesce(sum(capacity) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)) AS filled
        FROM {name}_nodes WINDOW o AS ({inside} ORDER BY capacity / weight, {path[-1]})
    ), {name} AS (
        SELECT {keys}, CASE WHEN filled THEN capacity ELSE
            (weight * (budget - CAST(coalesce(sum(CASE WHEN filled THEN capacity END) OVER ({inside}), 0) AS BIGINT)))
            // CAST(sum(CASE WHEN NOT filled THEN weight END) OVER ({inside}) AS BIGINT) END AS budget
        FROM {name}_marked
    )"""


def _weight(level: str) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {value}" for name, value in WEIGHTS.get(level, {}).items())
    return f"CAST(CASE {level} {cases} ELSE 1 END AS BIGINT)" if cases else "CAST(1 AS BIGINT)"


SQL: dict[str, str] = {
    "op9_source_mixing": rf"""
    WITH docs AS (
        SELECT doc_id,
               CASE WHEN regexp_extract(source, '([0-9]{{1,9}})$', 1) <> ''
                    THEN 'domain' || (CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT) % 4) ELSE 'unknown' END AS domain,
               coalesce(lang, 'unknown') AS language, coalesce(source, 'unknown') AS origin,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
        FROM documents
    ), root AS (SELECT CAST(sum(tokens) AS BIGINT) AS budget FROM docs),
    {_level("domains", "root", ["domain"], _weight("domain"))},
    {_level("languages", "domains", ["domain", "language"], _weight("language"))},
    {_level("origins", "languages", ["domain", "language", "origin"], _weight("origin"))},
    leaves AS (
        SELECT domain, language, origin,
               CASE WHEN sum(tokens) = 0 THEN 1 ELSE any_value(budget) // CAST(sum(tokens) AS BIGINT) END AS whole_epochs,
               CASE WHEN sum(tokens) = 0 THEN 0 ELSE any_value(budget) % CAST(sum(tokens) AS BIGINT) END AS rest
        FROM docs JOIN origins USING (domain, language, origin) GROUP BY ALL
    ), keyed AS (
        SELECT *, md5(concat_ws('|', '{SEED}', whole_epochs, doc_id)) AS place FROM docs JOIN leaves USING (domain, language, origin)
    ), summed AS (
        SELECT *, sum(tokens) OVER (PARTITION BY domain, language, origin ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until
        FROM keyed
    )
    SELECT doc_id, domain, language, origin, unnest(range(whole_epochs)) AS epoch FROM keyed
    UNION ALL SELECT doc_id, domain, language, origin, whole_epochs FROM summed WHERE until <= rest AND rest > 0
    """,
    "op5_near_duplicates": r"""
    WITH RECURSIVE worded AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, list_distinct(list_transform(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 4, 1) + 1 END),
                                                    lambda i: array_to_string(w[i:i + 4], ' '))) AS s
        FROM worded
    ), runs AS (
        SELECT doc_id, len(s) AS n, unnest(s) AS run FROM sets
    ), links AS (
        SELECT a.doc_id AS x, b.doc_id AS y FROM runs a JOIN runs b ON a.run = b.run AND a.doc_id < b.doc_id
            AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
    ), two_way AS (
        SELECT x, y FROM links UNION ALL SELECT y, x FROM links
    ), reach(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, b.y FROM reach r JOIN two_way b ON r.other = b.x
    )
    SELECT s.doc_id, len(s.s) AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
    FROM sets s JOIN reach r USING (doc_id) GROUP BY s.doc_id, s.s
    """,
    "op6_nearest_vectors": r"""
    WITH valid AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), pairs AS (
        SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(
            list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])), lambda x, y: x + y)) AS score
        FROM valid q JOIN valid c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS place FROM pairs
    )
    SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
    """,
    "op11_spelling_variants": rf"""
    WITH RECURSIVE runs AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
        FROM documents
    ), counted AS (
        SELECT run, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS named FROM runs GROUP BY doc_id, run
    ), bytes AS (
        SELECT run, n, flatten(list_transform(list_transform(range(1, length(named) + 1), lambda i: unicode(named[i])),
                                              lambda c: CASE WHEN c < 128 THEN [c] ELSE [192 + (c >> 6), 128 + (c & 63)] END)) AS b
        FROM counted
    ), checked AS (
        SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(b, lambda x: CAST(x AS BIGINT))), lambda crc, x:
            list_reduce([xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, zero: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295) AS h
        FROM bytes
    ), slipped AS (
        SELECT CASE WHEN h % {SLIP_EVERY} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM checked
    ), vocabulary AS (
        SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
    ), holes AS (
        SELECT word, i, substr(word, 1, i - 1) AS before, substr(word, i + 1) AS after
        FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
    ), shorter AS (
        SELECT DISTINCT h.word, v.word AS near FROM holes h JOIN vocabulary v ON v.word = h.before || h.after
    ), near AS (
        SELECT a.word, b.word AS near FROM holes a JOIN holes b ON a.i = b.i AND a.before = b.before AND a.after = b.after AND a.word <> b.word
        UNION ALL SELECT word, near FROM shorter UNION ALL SELECT near, word FROM shorter
    ), best AS (
        SELECT x.word, count(*) AS n_near, first(v.word ORDER BY v.n DESC, encode(v.word)) AS form, max(v.n) AS form_n
        FROM near x JOIN vocabulary v ON v.word = x.near GROUP BY x.word
    ), formed AS (
        SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN form_n >= 5 * v.n THEN form END AS form, CASE WHEN form_n >= 5 * v.n THEN form_n END AS form_n
        FROM vocabulary v LEFT JOIN best b USING (word)
    ), followed AS (
        SELECT word, word AS at FROM formed UNION ALL SELECT f.word, t.form FROM followed f JOIN formed t ON t.word = f.at WHERE t.form IS NOT NULL
    )
    SELECT f.word, f.n, f.n_near, f.form, f.form_n, r.at AS root
    FROM formed f JOIN followed r USING (word) JOIN formed t ON t.word = r.at WHERE t.form IS NULL
    """,
    "op12_hard_negatives": r"""
    WITH usable AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
        FROM usable a JOIN usable c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
    ), positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    ), ranked AS (
        SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS place
        FROM positives p JOIN scored s USING (anchor_id)
        WHERE NOT s.alike AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
    )
    SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE place <= 5
    """,
    "op13_near_vectors": r"""
    WITH RECURSIVE valid AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links AS (
        SELECT a.vec_id AS x, b.vec_id AS y FROM valid a JOIN valid b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        WHERE list_dot_product(a.v, b.v) >= 0.95 * sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))
    ), reach(vec_id, other) AS (
        SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.y FROM reach r JOIN links l ON r.other = l.x
    ), counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
    SELECT r.vec_id, coalesce(any_value(c.n), 0) AS n_links, min(r.other) AS component_id, r.vec_id = min(r.other) AS kept
    FROM reach r LEFT JOIN counted c ON c.x = r.vec_id GROUP BY r.vec_id
    """,
}
