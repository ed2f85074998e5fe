"""Secret scan: candidate strings, and a random forest that removes false positives; no Python on rows.

Candidates are runs of key-like characters with a digit, or with a capital inside a word; runs that begin like
a provider's key; whatever is assigned to a secret's name or stands in quotes after it; and passwords inside
URLs. Each is described
by its length, its character classes and their transitions, how much of it dictionary words cover, the
document's path, and the neighbouring words. A random forest learns from labelled findings.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendwork.session import materialise

from .common import bounded_sample, split_by_ids, unused

# Key-like characters; a run has a digit or a small letter before a capital.
_CHARACTERS = "A-Za-z0-9+/_-"
CANDIDATE = (
    rf"(?<![{_CHARACTERS}])(?=[{_CHARACTERS}]*?(?:[0-9]|[a-z][A-Z]))[{_CHARACTERS}]{{16,}}+={{0,2}}"
)
CONTEXT = 40
FIT_FINDINGS = 20_000
# A dictionary word stands in so many of a thousand distinct texts, and in two at least.
DICTIONARY_PER_MILLE = 10
TREES, DEPTH, SEED = 20, 6, 2

# Public shapes of provider keys.
FORMATS = r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|AIza[0-9A-Za-z_-]{35}|xox[abprs]-[0-9A-Za-z-]{10,}|sk-[A-Za-z0-9]{20,}|eyJ[A-Za-z0-9_-]{10,})"
# Names that secrets are given to, names of harmless values, and words of made-up values.
SECRET_NAMES = r"(?i)(api[_-]?key|access[_-]?key|secret|token|passw(or)?d|pwd|credential|private[_-]?key|bearer|auth)"
HARMLESS_NAMES = r"(?i)(sha(1|256|512)?|md5|checksum|commit|digest|hash|uuid|guid|version|order|invoice|phone|card|isbn)"
# Words that end a part of a name, and the parts and pairs of parts, that say that a value is secret.
SECRET_PARTS = r"(^|_)([a-z]*(secret|token|passw(or)?d|pwd|credential|apikey|accesskey|privatekey)s?|(o?auth|bearer)|(api|access|private)_keys?)[0-9]*(_|$)"
MADE_UP = r"(?i)(example|sample|dummy|placeholder|changeme|your[_-]|xxxx|test)"
# What stands where a value is missing or filled in later.
NO_VALUE = r"(?i)^(null|none|nil|true|false|undefined|\*+|\$?\{.*\}|\$\(.*\)|<.*>|%\(?\w+\)?[%s])$"

# Names of harmless and made-up values as whole parts of a name.
HARMLESS_PARTS = rf"(^|_)({HARMLESS_NAMES.removeprefix('(?i)')}|{MADE_UP.removeprefix('(?i)')})(s|es|id|no|num|number|sum|code|value)?[0-9]*(_|$)"

# A run that begins like a provider's key, whatever its characters.
KNOWN = rf"(?<![A-Za-z0-9]){FORMATS[1:]}[{_CHARACTERS}]*+={{0,2}}"
# A secret's name and what leads to its value (group 1), and the value: to the closing quote, or to a blank.
_NAMES = re.sub(r"\((?!\?)", "(?:", SECRET_NAMES.removeprefix("(?i)"))
_QUOTED = r"(?<=Q)(?:[^Q\\\n]|\\[^\n])++(?=Q)"
_BARE = r"[^\s\"'`<>;&]*[^\s\"'`<>;&,.)\]}]"
ASSIGNED = (
    rf"((?i:{_NAMES})[A-Za-z0-9_-]*+[\"'`\])]*+[ \t]*+"
    r"(?:(?::=|=>|==?|:(?!:))[ \t]*+(?i:(?:bearer|basic)[ \t]++)?[\"'`]?"
    r"|(?=\"[^\"\n]+\"|'[^'\n]+'|`[^`\n]+`)[\"'`]))"
    rf"(?:{'|'.join(_QUOTED.replace('Q', q) for q in ('"', "'", '`'))}|{_BARE})"
)
# A password inside a URL, and what leads to it (group 1).
IN_URL = r"(://[^\s:@/\"'`<>]*+:)[^\s@/\"'`<>]++(?=@)"
# Fixed value: the public shape of a UUID.
UUID = r"(?i)^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$"
PATTERNS = (CANDIDATE, KNOWN, ASSIGNED, IN_URL)
# Strings of this length are masked wherever they stand, shorter ones only after what stands before them.
ANYWHERE = 16

FEATURES = [
    "length", "digits", "capitals", "small", "symbols", "runs", "distinct", "turns", "dictionary", "hexadecimal",
    "format", "path_depth", "path_example", "path_config", "named_before", "named_near", "harmless_before", "secret_part", "assigned", "quoted", "made_up",
]


def text_key(id_column: str, text_column: str) -> Column:
    """A row's id; without one, a hash of its text, so that its findings can be told from those of other rows."""
    return F.coalesce(F.col(f"`{id_column}`").cast("long"), F.xxhash64(F.col(f"`{text_column}`").cast("string")))


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path_column: str = "source") -> DataFrame:
    """One row per candidate: doc_id, text_key, path, line and start (both from 0), the string, and what stands around it.

    Texts are cut into lines, so a candidate's place costs no more than its line. Missing texts have none.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        text_key(id_column, text_column).alias("text_key"),
        F.col(f"`{path_column}`").cast("string").alias("path"),
        text.alias("text"),
    )
    has_any = lambda x: x.rlike(CANDIDATE) | x.rlike(KNOWN) | x.rlike(ASSIGNED) | x.rlike(IN_URL)
    lines = F.filter(
        F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("body"))),
        lambda x: has_any(x["body"]),
    )
    by_line = rows.where(has_any(F.col("text"))).select("doc_id", "text_key", "path", F.explode(lines).alias("l"))
    # What lies between the matches of a pattern, and the matches: together they are the line.
    body, parts = F.col("l.body"), ["doc_id", "text_key", "path", F.col("l.line").alias("line")]
    for kind, pattern in enumerate(PATTERNS):
        found = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
        leads = F.regexp_extract_all(body, F.lit(pattern), F.lit(1)) if pattern in (ASSIGNED, IN_URL) else F.transform(found, lambda x: F.lit(""))
        parts += [found.alias(f"found{kind}"), leads.alias(f"leads{kind}"), F.split(body, pattern, -1).alias(f"gaps{kind}")]
    pieces = [
        F.expr(
            f"""transform(found{k}, (c, i) -> named_struct(
            'start', aggregate(slice(gaps{k}, 1, i + 1), 0, (a, g) -> a + length(g)) + aggregate(slice(found{k}, 1, i), 0, (a, g) -> a + length(g))
                + length(leads{k}[i]),
            'candidate', substring(c, length(leads{k}[i]) + 1),
            'kind', -{k},
            'before', concat(right(gaps{k}[i], {CONTEXT}), leads{k}[i]),
            'after', left(gaps{k}[i + 1], {CONTEXT})))"""
        )
        for k in range(len(PATTERNS))
    ]
    # The same string at the same place counts once, with the lead of the later pattern: a name is whole there.
    every = by_line.select(*parts).select("doc_id", "text_key", "path", "line", F.array_sort(F.concat(*pieces)).alias("every"))
    first = F.expr("filter(every, (x, i) -> i = 0 or every[i - 1].start != x.start or every[i - 1].candidate != x.candidate)")
    found = every.select("doc_id", "text_key", "path", "line", F.explode(first).alias("p"))
    return found.select("doc_id", "text_key", "path", "line", "p.candidate", "p.start", "p.before", "p.after")


def dictionary(docs: DataFrame, per_mille: int = DICTIONARY_PER_MILLE, text_column: str = "text") -> DataFrame:
    """Small-letter words of three letters or more that stand in at least this share of the distinct texts, and in two.

    Candidates are taken out first, so a secret's letters are no words however often it is repeated; copies
    of a text count once. Only texts whose hash occurs again are moved, to compare them in full.
    """
    text = docs.select(F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text")).where("text != ''")
    text = text.withColumn("hash", F.xxhash64("text"))
    again = materialise(text.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "repeated-texts")
    maybe, others = split_by_ids(text, "hash", again)
    distinct = others.select("text").union(maybe.select("text").distinct())
    clean = F.col("text")
    for pattern, instead in ((IN_URL, "$1 "), (ASSIGNED, "$1 "), (KNOWN, " "), (CANDIDATE, " ")):
        clean = F.regexp_replace(clean, pattern, instead)
    # The empty word stands for the text itself.
    words = F.array_distinct(F.filter(F.split(F.lower(clean), "[^a-z]+"), lambda x: F.length(x) >= 3))
    counted = distinct.select(F.explode(F.concat(F.array(F.lit("")), words)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counted = materialise(counted, "word-counts")
    texts = F.broadcast(counted.where("word = ''").select(F.col("n").alias("texts")))
    return counted.where("word != ''").crossJoin(texts).where((F.col("n") >= 2) & (1000 * F.col("n") >= per_mille * F.col("texts"))).select("word")


def share(column: str, unwanted: str) -> Column:
    """The share of the characters that remain after the unwanted ones are taken out."""
    return F.length(F.regexp_replace(column, unwanted, "")) / F.length(column)


def name_parts(name: Column) -> Column:
    """The name in small letters, with one _ between its parts: it is cut at _, - and case changes."""
    cut = F.regexp_replace(F.regexp_replace(name, "([a-z0-9])([A-Z])", "$1_$2"), "([A-Z])([A-Z][a-z])", "$1_$2")
    return F.lower(F.regexp_replace(cut, "[_-]+", "_"))


def describe(found: DataFrame, words: DataFrame) -> DataFrame:
    """The features of ``candidates``, as numbers; nothing here looks at other rows but the dictionary."""
    c = F.col("candidate")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[0-9]", "9"), "[A-Z]", "A"), "[a-z]", "a"), "[^9Aa]", "#")
    runs = F.length(F.regexp_replace(classes, r"(.)\1*", "x"))
    letters = F.length(F.regexp_replace(c, "[^A-Za-z]", ""))
    # Consonants and vowels take turns in words, but not in random strings.
    sounds = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(c, "[^A-Za-z]", "")), "[aeiouy]", "0"), "[a-z]", "1")
    turns = F.length(F.regexp_replace(sounds, r"(.)\1*", "x")) / F.greatest(letters, F.lit(1))
    one = lambda condition: F.coalesce(condition, F.lit(False)).cast("double")
    path = F.coalesce("path", F.lit(""))
    last = F.regexp_extract("before", r"([A-Za-z0-9_-]+)[^A-Za-z0-9_-]*$", 1)
    parts = name_parts(last)
    # Shapes count like names: a password's place in a URL like a provider's key, a UUID like a harmless name.
    in_url = one(F.col("before").rlike("://[^\\s:@/]*:$") & F.col("after").startswith("@"))
    described = found.select(
        "*",
        F.length(c).cast("double").alias("length"),
        share("candidate", "[^0-9]").alias("digits"),
        share("candidate", "[^A-Z]").alias("capitals"),
        share("candidate", "[^a-z]").alias("small"),
        share("candidate", "[A-Za-z0-9]").alias("symbols"),
        (runs / F.length(c)).alias("runs"),
        (F.size(F.array_distinct(F.split(c, ""))) / F.length(c)).alias("distinct"),
        turns.alias("turns"),
        one(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hexadecimal"),
        F.greatest(one(c.rlike(FORMATS)), in_url).alias("format"),
        F.length(F.regexp_replace(path, "[^/]", "")).cast("double").alias("path_depth"),
        one(path.rlike("(?i)(test|example|sample|mock|fixture|doc)")).alias("path_example"),
        one(path.rlike(r"(?i)(\.env|conf|\.ini|\.ya?ml|\.json|\.pem|prop)")).alias("path_config"),
        one(last.rlike(SECRET_NAMES)).alias("named_before"),
        one(F.concat("before", "after").rlike(SECRET_NAMES)).alias("named_near"),
        F.greatest(one(parts.rlike(HARMLESS_PARTS)), one(c.rlike(UUID) & ~parts.rlike(SECRET_PARTS))).alias("harmless_before"),
        one(parts.rlike(SECRET_PARTS)).alias("secret_part"),
        one(F.col("before").rlike(r"(?:[:=]|=>)\s*[\"'`]?$")).alias("assigned"),
        one(F.col("before").rlike(r"[\"'`]$") & F.col("after").rlike(r"^[\"'`]")).alias("quoted"),
        one(c.rlike(MADE_UP) | c.rlike(NO_VALUE)).alias("made_up"),
    )
    # Covered letters: letter runs of the candidate that are dictionary words.
    pieces = described.select(c, F.explode(F.regexp_extract_all(F.lower(c), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    pieces = pieces.groupBy("candidate", "word").agg(F.lit(1).alias("one")).select("candidate", "word")
    covered = pieces.join(words, "word", "left_semi").groupBy("candidate").agg(F.sum(F.length("word")).alias("covered"))
    return described.join(covered, "candidate", "left").withColumn(
        "dictionary", F.least(F.lit(1.0), F.coalesce("covered", F.lit(0)) / F.length("candidate"))
    ).drop("covered")


def rule_labels(described: DataFrame) -> DataFrame:
    """Findings labelled by rules that are nearly always right; what they don't decide has no label.

    1: a provider's key shape, a password in a URL, or a value assigned to a secret's name, that isn't made up. 0: made-up values, bare
    words after a name, values of harmless names and UUIDs, digits only, and values without any sign of a secret that
    consist of words. A name that only holds a secret's name, like "author", decides for values with digits alone.
    A key shape and an assigned part like "token" win over a harmless part of the same name.
    """
    words = (F.col("quoted") == 0) & (F.col("digits") == 0) & (F.col("dictionary") >= 0.5) & (F.col("format") == 0)
    label = (
        F.when((F.col("made_up") == 1) | words, 0)
        .when((F.col("format") == 1) | (F.col("secret_part") == 1) & (F.col("assigned") == 1), 1)
        .when(F.col("harmless_before") == 1, 0)
        .when((F.col("named_before") == 1) & (F.col("assigned") == 1) & (F.col("digits") > 0), 1)
        .when((F.col("digits") == 1) | (F.col("dictionary") >= 0.5), 0)
        .when((F.col("named_near") == 0) & (F.col("assigned") == 0) & (F.col("turns") >= 0.6) & (F.col("digits") < 0.2), 0)
    )
    return described.withColumn("label", label)


def fit_forest(labelled: DataFrame, bound: int = FIT_FINDINGS):
    """A forest from findings with a ``label`` of 0 or 1, at most about ``bound`` of them, chosen by a hash.

    A rare label keeps a tenth of the bound, or all it has. With one kind of label only that label (as a number) is returned, with none at all 0.
    """
    rows = labelled.where("label is not null").withColumn("_key", F.xxhash64("doc_id", "line", "start", "candidate"))
    rows = bounded_sample(rows, "_key", bound, kind="label", least=bound // 10)
    kinds = [r.label for r in rows.select("label").distinct().collect()]
    if len(kinds) < 2:
        return float(kinds[0]) if kinds else 0.0
    rows = rows.select(*FEATURES, F.col("label").cast("double"))
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt"
    )
    return forest.fit(_assembled(rows))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def score(described: DataFrame, forest) -> DataFrame:
    """``score``: the forest's probability that the finding is a secret."""
    if isinstance(forest, float):
        return described.withColumn("score", F.lit(forest))
    scored = forest.transform(_assembled(described))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def scan(docs: DataFrame, threshold: float = 0.5, bound: int = FIT_FINDINGS, **columns: str) -> DataFrame:
    """(doc_id, line, start, length, candidate, score, predicted) for every candidate of every document.

    Lines and starts count from 0, in characters. Without an id the ``doc_id`` is null; repeated rows give
    repeated findings. A missing or empty text, and an empty table, give none. Other columns are ignored.
    Candidates may overlap: a value with other characters is one, and a key-like run inside it is another.
    """
    return scored(docs, threshold, bound, **columns).drop("text_key", "before")


def scored(docs: DataFrame, threshold: float = 0.5, bound: int = FIT_FINDINGS, **columns: str) -> DataFrame:
    """``scan`` with ``text_key`` and with ``before``, what stands before the candidate in its line."""
    found = materialise(candidates(docs, **columns), "secret-candidates")
    text = {k: v for k, v in columns.items() if k == "text_column"}
    described = materialise(rule_labels(describe(found, dictionary(docs, **text))), "secret-features")
    judged = score(described, fit_forest(described, bound))
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return judged.select("doc_id", "line", "start", F.length("candidate").alias("length"), "candidate", "score", predicted, "text_key", "before")


def redact(docs: DataFrame, mask: str = "[secret]", id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` with every predicted secret of a document replaced in its text; same columns and rows.

    Rows without an id are told apart by a hash of their text, so their secrets are masked like any others.
    ``n_chars``, if there is such a column, is counted anew where a text changes.
    """
    found = scored(docs, id_column=id_column, text_column=text_column, **options)
    secrets = found.where("predicted = 1").groupBy("text_key").agg(F.collect_set(F.struct("length", "candidate", "before")).alias("s"))
    key, strings, text = unused(docs, "found_id"), unused(docs, "found"), F.col(f"`{text_column}`")
    # One pattern per document, longer strings first, so that one that holds another is replaced as a whole.
    literal = lambda x: F.concat(F.lit("\\Q"), F.replace(x, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    one = lambda x: F.when(x["length"] >= ANYWHERE, literal(x["candidate"])).otherwise(
        F.concat(F.lit("(?<="), literal(x["before"]), F.lit(")"), literal(x["candidate"]))
    )
    secrets = secrets.select(F.col("text_key").alias(key), F.array_join(F.transform(F.reverse(F.array_sort("s")), one), "|").alias(strings))
    secrets = materialise(secrets, "secrets")
    own = unused(docs, "text_key")
    maybe, others = split_by_ids(docs.withColumn(own, text_key(id_column, text_column)), own, secrets.select(key))
    joined = maybe.join(secrets, F.col(own) == F.col(key), "left")
    clean = F.regexp_replace(text, F.col(strings), F.lit(re.sub(r"([\\$])", r"\\\1", mask)))
    changed = {text_column: F.when(F.col(strings).isNull(), text).otherwise(clean)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(strings).isNull(), F.col("n_chars")).otherwise(F.length(clean).cast("long"))
    return others.drop(own).union(joined.select(*(changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns)))
