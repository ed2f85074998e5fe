"""Language of texts, with spans of mixed-language texts.

A word's script leaves the languages that are written in it. Each of them gives the word a score: the mean
log-probability of its letter n-grams in that language. Viterbi over the words, with a penalty for every
switch, labels spans; the document's language is the one whose spans have the most letters.
"""

from __future__ import annotations

import unicodedata
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import bounded_sample, map_rows, utf8, worker_cache

common.ship(__name__)

GRAMS = (1, 2, 3, 4)
BUCKETS = 1 << 15
FIT_DOCUMENTS = 20_000
SWITCH = 4.0
MEMO_WORDS = 300_000
SLICE_ROWS = 2000
CHUNK_WORDS = 20_000

# First letters of ranges and their script; a range ends where the next begins.
SCRIPTS = [
    (0x0041, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0900, "indic"),
    (0x0E00, "thai"),
    (0x0E80, "other"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD800, "other"),
    (0xF900, "han"),
    (0xFB00, "other"),
    (0x20000, "han"),
]
STARTS = [start for start, _ in SCRIPTS]
NAMES = sorted({name for _, name in SCRIPTS})


def letters_of(word: str) -> str:
    """The word's letters, composed and in lower case."""
    if not word.isalpha():
        word = word.rstrip(".,")
        if not word.isalpha():
            word = "".join([c for c in word if c.isalpha()])
    return word.lower() if word.isascii() else unicodedata.normalize("NFC", word).lower()


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters one after the other, and the number of the word of each."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return points, np.repeat(np.arange(len(words)), [len(w) for w in words])


def scripts_of(words: list[str]) -> np.ndarray:
    """The script of most letters of each word (ties: the first by name), as numbers."""
    points, owner = code_points(words)
    numbers = np.array([NAMES.index(name) for _, name in SCRIPTS])
    script = numbers[np.maximum(0, np.searchsorted(STARTS, points, side="right") - 1)]
    votes = np.bincount(owner * len(NAMES) + script, minlength=len(words) * len(NAMES))
    return votes.reshape(len(words), len(NAMES)).argmax(axis=1)


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of words with their borders marked, and the number of the word of each."""
    points, owner = code_points([f"<{w}>" for w in words])
    border = np.ones(len(points), dtype=bool)
    border[1:-1] = (owner[1:-1] != owner[:-2]) | (owner[1:-1] != owner[2:])
    buckets, owners = [], []
    for n in GRAMS:
        length = len(points) - n + 1
        hashes = np.full(max(0, length), n, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for i in range(n):
                hashes = (hashes + points[i : i + length]) * np.uint64(0x9E3779B97F4A7C15)
                hashes ^= hashes >> np.uint64(29)
        inside = ~border if n == 1 else owner[:length] == owner[n - 1 :]
        buckets.append((hashes[inside] % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(owner[:length][inside])
    return np.concatenate(buckets), np.concatenate(owners)


class Model:
    """Log-probabilities per bucket and language, and the languages of each script."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray) -> None:
        self.languages = languages
        smooth = counts + 0.5
        self.logs = (np.log(smooth) - np.log(smooth.sum(axis=0))).astype(np.float32)
        # A language has a script if a hundredth of its letters is written in it.
        share = scripts / np.maximum(1, scripts.sum(axis=0))
        self.allowed = share >= 0.01
        self.allowed[~self.allowed.any(axis=1)] = True

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Per word and language the log-likelihood against the word's best language, by n-gram and letter."""
        out = np.zeros((len(words), len(self.languages)), dtype=np.float32)
        for begin in range(0, len(words), CHUNK_WORDS):
            some = words[begin : begin + CHUNK_WORDS]
            buckets, owner = grams_of(some)
            counts = np.bincount(owner, minlength=len(some))
            sums = np.stack([np.bincount(owner, weights=column[buckets], minlength=len(some)) for column in self.logs.T], axis=1)
            scores = sums * (np.minimum([len(w) for w in some], 12) / counts)[:, None]
            scores = np.where(self.allowed[scripts_of(some)], scores, scores.min(axis=1, keepdims=True) - 60.0)
            out[begin : begin + CHUNK_WORDS] = np.maximum(scores - scores.max(axis=1, keepdims=True), -12.0)
        return out


def fit(docs: DataFrame, bound: int = FIT_DOCUMENTS, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Model | None:
    """Fit on at most about ``bound`` documents of each language, chosen by a hash of the id.

    Each task counts its words first and n-grams once per distinct word; what reaches the driver is the table
    of buckets and languages, whose size the data do not change. Nothing to learn from gives None.
    """
    rows = docs.where(F.col(f"`{lang_column}`").isNotNull() & F.col(f"`{text_column}`").isNotNull())
    rows = bounded_sample(rows.select(id_column, text_column, lang_column), id_column, bound, kind=lang_column, least=bound)

    def count(lists: dict[str, list]) -> dict[str, list]:
        words: dict[str, dict[bytes, int]] = {}
        for raw, lang in zip(lists["text"], lists["lang"], strict=True):
            own = words.setdefault(lang, {})
            for word in raw.split():
                own[word] = own.get(word, 0) + 1
        out: dict[str, list] = {"lang": [], "bucket": [], "n": []}
        for lang, own in words.items():
            pairs = [(letters, n) for word, n in own.items() if (letters := letters_of(word.decode("utf-8")))]
            sums = np.zeros(BUCKETS + len(NAMES))
            for begin in range(0, len(pairs), CHUNK_WORDS):
                some, weights = zip(*pairs[begin : begin + CHUNK_WORDS], strict=True)
                buckets, owner = grams_of(list(some))
                weights = np.array(weights, dtype=np.float64)
                sums[:BUCKETS] += np.bincount(buckets, weights=weights[owner], minlength=BUCKETS)
                size = weights * [len(w) for w in some]
                sums[BUCKETS:] += np.bincount(scripts_of(list(some)), weights=size, minlength=len(NAMES))
            full = np.flatnonzero(sums)
            out["lang"] += [lang] * len(full)
            out["bucket"] += full.tolist()
            out["n"] += sums[full].astype(np.int64).tolist()
        return out

    counted = map_rows(
        rows.select(utf8(text_column).alias("text"), F.col(f"`{lang_column}`").cast("string").alias("lang")),
        count,
        "lang string, bucket int, n long",
        slice_rows=SLICE_ROWS,
    )
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    if not len(table):
        return None
    languages = sorted(table["lang"].unique())
    full = np.zeros((BUCKETS + len(NAMES), len(languages)))
    full[table["bucket"].to_numpy(), np.searchsorted(languages, table["lang"])] = table["n"].to_numpy()
    return Model(languages, full[:BUCKETS], full[BUCKETS:])


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word of several texts at once.

    ``scores`` holds the words of all texts one after the other; texts are sorted from the longest down, so
    that the texts that still have a word at some position are the first ones.
    """
    starts = np.cumsum(lengths) - lengths
    labels = np.zeros(len(scores), dtype=np.int16)
    if not len(scores):
        return labels
    steps = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    state = np.zeros((len(lengths), scores.shape[1]), dtype=np.float32)
    stays = np.zeros(scores.shape, dtype=bool)
    top = np.zeros(len(scores), dtype=np.int16)
    for t in range(steps):
        n = active[t]
        at, own = starts[:n] + t, state[:n]
        best = own.argmax(axis=1)
        switch = own[np.arange(n), best][:, None] - penalty
        stay = own >= switch
        stays[at], top[at] = stay, best
        state[:n] = np.where(stay, own, switch) + scores[at]
    label = state.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at, now = starts[:n] + t, label[:n]
        labels[at] = now
        label[:n] = np.where(stays[at, now], now, top[at])
    return labels


def predict(
    texts: list[bytes], model: Model | None, name: str, penalty: float, keep_spans: bool = False, by_span: bool = False
) -> tuple[list[str], list[float], list]:
    """Languages, scores and spans of texts; ``name`` tells the model apart in the worker's memo.

    With ``by_span`` each word counts with the share of its own span's language, not of the text's.
    """
    n = len(texts)
    labels_out, scores_out, spans_out = ["und"] * n, [0.0] * n, [[] for _ in range(n)]
    if model is None:
        return labels_out, scores_out, spans_out
    languages = model.languages
    memo = worker_cache("language-words")
    if memo.get("model") != name or len(memo["rows"]) > MEMO_WORDS:
        memo.update(model=name, rows={}, scores=np.zeros((1, len(languages)), np.float32), letters=np.zeros(1, np.int64))
    known = memo["rows"]
    fresh: list[str] = []
    numbers, lengths = [], []
    for raw in texts:
        words = raw.split()
        for word in {w for w in words if w not in known}:
            chars = letters_of(word.decode("utf-8"))
            known[word] = len(memo["letters"]) + len(fresh) if chars else 0
            if chars:
                fresh.append(chars)
        numbers.append(np.fromiter((known[w] for w in words), dtype=np.int64, count=len(words)))
        lengths.append(len(words))
    if fresh:
        memo["scores"] = np.concatenate([memo["scores"], model.word_scores(fresh)])
        memo["letters"] = np.concatenate([memo["letters"], [len(w) for w in fresh]])
    order = np.argsort(-np.array(lengths), kind="stable")
    flat = np.concatenate([numbers[i] for i in order])
    word_scores, sizes = memo["scores"][flat], memo["letters"][flat]
    counts = np.array(lengths)[order]
    labels = viterbi(word_scores, counts, penalty)
    begin = 0
    for i, length in zip(order.tolist(), counts.tolist(), strict=True):
        own, weight = labels[begin : begin + length], sizes[begin : begin + length]
        if weight.any():
            best = int(np.bincount(own, weights=weight, minlength=len(languages)).argmax())
            chance = np.exp(word_scores[begin : begin + length])
            judged = chance[np.arange(length), own] if by_span else chance[:, best]
            sure = (judged / chance.sum(axis=1)) @ weight / weight.sum()
            labels_out[i] = languages[best]
            scores_out[i] = float(min(1.0, max(0.0, sure)))
            if keep_spans:
                edges = np.flatnonzero(np.diff(own)) + 1
                firsts, ends = [0, *edges.tolist()], [*edges.tolist(), length]
                spans_out[i] = [{"lang": languages[own[a]], "start": a, "words": b - a} for a, b in zip(firsts, ends, strict=True)]
        begin += length
    return labels_out, scores_out, spans_out


def detect(
    docs: DataFrame,
    model: Model | None,
    penalty: float = SWITCH,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_spans: bool = False,
) -> DataFrame:
    """(doc_id, lang_pred, score) for every row; with ``keep_spans`` also (lang, first word, words) per span.

    ``lang_pred`` is "und" where the text is missing or has no letter, and where there is no model; its score
    is 0. Otherwise the score is the language's mean share of the words' likelihoods, weighted by letters.
    Repeated rows and missing ids stay as they are; other columns are ignored.
    """
    name = uuid.uuid4().hex

    def work(lists: dict[str, list]) -> dict[str, list]:
        labels, scores, spans = predict(lists["text"], model, name, penalty, keep_spans)
        return {"doc_id": lists["doc_id"], "lang_pred": labels, "score": scores, "spans": spans}

    found = map_rows(
        docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), utf8(text_column).alias("text")),
        work,
        "doc_id long, lang_pred string, score double, spans array<struct<lang string, start long, words long>>",
        slice_rows=SLICE_ROWS,
    )
    return found if keep_spans else found.drop("spans")


def keep_recognised(docs: DataFrame, model: Model | None, least: float = 0.3, penalty: float = SWITCH, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose languages are recognised; same columns.

    A text is judged by how sure its labelled spans are: the mean share of each span's own language, weighted by
    letters, has to be at least ``least``, however many languages it mixes. Rows without text or letters go.
    Without a model nothing can be recognised, and all texts with letters stay. Rows are filtered where they are read, so nothing is joined or moved.
    """
    name = uuid.uuid4().hex
    at = docs.columns.index(text_column)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(begin, SLICE_ROWS)
                texts = [(t or "").encode("utf-8") for t in part.column(at).to_pylist()]
                if model is None:
                    yield part.filter(pa.array([any(letters_of(w.decode("utf-8")) for w in t.split()) for t in texts]))
                    continue
                labels, scores, _ = predict(texts, model, name, penalty, by_span=True)
                yield part.filter(pa.array([a != "und" and b >= least for a, b in zip(labels, scores, strict=True)]))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, learn_from: Column, bound: int = FIT_DOCUMENTS, penalty: float = SWITCH, **columns: str) -> DataFrame:
    """Fit on the rows where ``learn_from`` is true and predict every row."""
    names = {k: v for k, v in columns.items() if k != "lang_column"}
    return detect(docs, fit(docs.where(learn_from), bound, **columns), penalty, **names)
