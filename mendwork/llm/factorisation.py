"""Quality classifier: a factorisation machine over hashed words, structure statistics and size.

score(x) = bias + w.x + sum over pairs i < j of (v_i . v_j) x_i x_j. The pair sum is computed in time linear
in the number of features by the identity 1/2 (|sum v_i x_i|^2 - sum |v_i x_i|^2).

Only the text is looked at: its words (hashed), statistics of its structure, and its size.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import bounded_sample, map_rows, utf8, worker_cache

common.ship(__name__)

WORD_BUCKETS = 1 << 13
BINS = 12
RANK = 4
FIT_DOCUMENTS = 6_000
EPOCHS = 12
BATCH = 64
RATE = 0.02
DECAY = 1e-4
MEMO_WORDS = 400_000
SLICE_ROWS = 500

# The word shapes that are told apart, in this order.
SHAPES = ["lower", "title", "upper", "digits", "stopped", "symbols", "mixed"]


def shape_of(word: str) -> int:
    """The word's shape: letters by case, digits, letters with a stop, no letter or digit, anything else."""
    if word.isalpha():
        return 0 if word.islower() else 1 if word[1:].islower() else 2 if word.isupper() else 6
    if word.isdigit():
        return 3
    if word[:-1].isalpha() and word[-1] in ".,;:":
        return 4
    if not any(c.isalnum() for c in word):
        return 5
    return 6


STATISTICS = [
    *(f"share_{s}" for s in SHAPES),
    "distinct_words",
    "repeated_lines",
    "word_length",
    "line_words",
    "punctuation",
    "digit_characters",
    "top_word",
    "log_words",
    "log_characters",
]
FEATURES = WORD_BUCKETS + len(STATISTICS) * BINS


def describe(raw: bytes, words: list[int], shapes: np.ndarray) -> np.ndarray:
    """Structure statistics between 0 and 1; all zero for an empty text."""
    out = np.zeros(len(STATISTICS))
    n = len(words)
    if not n:
        return out
    out[: len(SHAPES)] = np.bincount(shapes, minlength=len(SHAPES)) / n
    lines = [line for line in raw.split(b"\n") if line.strip()]
    counts = np.unique(words, return_counts=True)[1]
    data = np.frombuffer(raw, dtype=np.uint8)
    classes = np.bincount(BYTE_CLASS[data], minlength=3)
    out[len(SHAPES) :] = [
        len(counts) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        min(1.0, len(raw) / n / 20),
        min(1.0, n / max(1, len(lines)) / 100),
        classes[1] / len(raw),
        classes[2] / len(raw),
        counts.max() / n,
        min(1.0, np.log1p(n) / 12),
        min(1.0, np.log1p(len(raw)) / 14),
    ]
    return out


# Per byte: 1 for ASCII punctuation, 2 for a digit, else 0.
BYTE_CLASS = np.array([2 if 48 <= b <= 57 else 1 if 33 <= b <= 47 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 126 else 0 for b in range(256)])


def features(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of a text: numbers and values. Words weigh ln(1 + count), scaled to length 1."""
    memo = worker_cache("factorisation-words")
    if len(memo) > MEMO_WORDS:
        memo.clear()
    words = raw.split()
    for word in {w for w in words if w not in memo}:
        memo[word] = (zlib.crc32(word.lower()) % WORD_BUCKETS) * 8 + shape_of(word.decode("utf-8"))
    codes = np.fromiter((memo[w] for w in words), dtype=np.int64, count=len(words))
    buckets, counts = np.unique(codes >> 3, return_counts=True)
    weights = np.log1p(counts)
    if len(weights):
        weights = weights / np.sqrt(weights @ weights)
    statistics = describe(raw, codes >> 3, codes & 7)
    # A statistic is shared between the two bins around it, so a small change moves the score a little.
    place = statistics * (BINS - 1)
    low = np.minimum(place.astype(np.int64), BINS - 2)
    high = place - low
    base = WORD_BUCKETS + np.arange(len(statistics)) * BINS + low
    scale = 1 / np.sqrt(len(statistics))
    return np.concatenate([buckets, base, base + 1]), np.concatenate([weights, (1 - high) * scale, high * scale])


class Machine:
    """Weights of a factorisation machine; ``sparse`` rows are (numbers, values)."""

    def __init__(self, n_features: int, rank: int, seed: int = 4) -> None:
        rng = np.random.default_rng(seed)
        self.bias = 0.0
        self.weights = np.zeros(n_features)
        self.factors = rng.normal(0, 0.05, (n_features, rank))

    def score(self, numbers: np.ndarray, values: np.ndarray) -> float:
        parts = self.factors[numbers] * values[:, None]
        total = parts.sum(axis=0)
        pairs = 0.5 * (total @ total - (parts * parts).sum())
        return float(self.bias + self.weights[numbers] @ values + pairs)

    def probability(self, numbers: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.score(numbers, values), -30, 30))))

    def train(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int, rate: float, decay: float, batch: int, seed: int = 4) -> None:
        """Logistic loss, mini-batches, steps scaled per weight by its past gradients."""
        rng = np.random.default_rng(seed)
        past_w, past_v, past_b = np.full(len(self.weights), 1e-8), np.full(self.factors.shape, 1e-8), 1e-8
        share = min(0.99, max(0.01, labels.mean()))
        self.bias = float(np.log(share / (1 - share)))
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(rows), batch):
                some = order[at : at + batch]
                numbers = np.concatenate([rows[i][0] for i in some])
                values = np.concatenate([rows[i][1] for i in some])
                lengths = np.array([len(rows[i][0]) for i in some])
                first = np.cumsum(lengths) - lengths
                parts = self.factors[numbers] * values[:, None]
                totals = np.add.reduceat(parts, first, axis=0)
                pairs = 0.5 * ((totals**2).sum(axis=1) - np.add.reduceat((parts**2).sum(axis=1), first))
                scores = self.bias + np.add.reduceat(self.weights[numbers] * values, first) + pairs
                errors = (1 / (1 + np.exp(-np.clip(scores, -30, 30))) - labels[some]) / len(some)
                each = np.repeat(errors, lengths) * values
                near, back = np.unique(numbers, return_inverse=True)
                grad_w = np.bincount(back, weights=each) + decay * self.weights[near]
                grads = each[:, None] * (np.repeat(totals, lengths, axis=0) - parts)
                grad_v = np.stack([np.bincount(back, weights=g) for g in grads.T], axis=1) + decay * self.factors[near]
                past_w[near] += grad_w**2
                past_v[near] += grad_v**2
                past_b += errors.sum() ** 2
                self.weights[near] -= rate * 5 * grad_w / np.sqrt(past_w[near])
                self.factors[near] -= rate * grad_v / np.sqrt(past_v[near])
                self.bias -= rate * errors.sum() / np.sqrt(past_b)


def fit(docs: DataFrame, labels: DataFrame, bound: int = FIT_DOCUMENTS, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> Machine | None:
    """Fit on at most about ``bound`` labelled documents, chosen by a hash of the id; None if there are none.

    Their features are computed by Spark; the bounded table of features is what the driver trains on.
    An id that rows repeat counts once, and a rare label keeps a tenth of the bound, or all it has. An id with several labels counts as labelled 1 if most of them are.
    """
    named = labels.where(F.col(f"`{id_column}`").isNotNull() & F.col(f"`{label_column}`").isNotNull())
    named = named.groupBy(F.col(f"`{id_column}`").cast("long").alias("_id")).agg((F.avg(label_column) >= 0.5).cast("int").alias("_label"))
    named = bounded_sample(named, "_id", bound, kind="_label", least=bound // 10)
    texts = docs.select(F.col(f"`{id_column}`").cast("long").alias("_id"), utf8(text_column).alias("text"))

    def work(lists: dict[str, list]) -> dict[str, list]:
        made = [features(t) for t in lists["text"]]
        return {"id": lists["_id"], "label": lists["_label"], "numbers": [n.tolist() for n, _ in made], "values": [v.tolist() for _, v in made]}

    # Rows that repeat an id are one document.
    once = texts.join(F.broadcast(named), "_id").groupBy("_id", "_label").agg(F.max("text").alias("text"))
    found = map_rows(once, work, "id long, label int, numbers array<int>, values array<float>", SLICE_ROWS)
    table = found.toArrow().sort_by("id")
    if not table.num_rows:
        return None
    numbers, values = (table.column(c).combine_chunks() for c in ("numbers", "values"))
    rows = [(np.asarray(n.values, dtype=np.int64), np.asarray(v.values, dtype=np.float64)) for n, v in zip(numbers, values, strict=True)]
    machine = Machine(FEATURES, RANK)
    machine.train(rows, np.asarray(table.column("label"), dtype=np.float64), EPOCHS, RATE, DECAY, BATCH)
    machine.weights, machine.factors = machine.weights.astype(np.float32), machine.factors.astype(np.float32)
    return machine


def score(docs: DataFrame, machine: Machine | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, score) for every row: the probability of label 1, from the text alone.

    Missing and empty texts are scored like any other by their (empty) features. Without a machine every
    score is 0.5. Repeated rows and missing ids stay as they are.
    """

    def work(lists: dict[str, list]) -> dict[str, list]:
        scores = [machine.probability(*features(t)) if machine else 0.5 for t in lists["text"]]
        return {"doc_id": lists["doc_id"], "score": scores}

    return map_rows(
        docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), utf8(text_column).alias("text")), work, "doc_id long, score double", SLICE_ROWS
    )


def classify(docs: DataFrame, labels: DataFrame, learn_from: Column, bound: int = FIT_DOCUMENTS, **columns: str) -> DataFrame:
    """Fit on the labelled documents whose label row satisfies ``learn_from``; score every document."""
    names = {k: v for k, v in columns.items() if k != "label_column"}
    return score(docs, fit(docs, labels.where(learn_from), bound, **columns), **names)
