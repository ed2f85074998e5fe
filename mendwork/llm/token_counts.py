"""Token counts by dynamic programming over prefixes.

The library merges neighbouring symbols, best-scored piece first. Two facts make that a recurrence: the
encoding of a prefix is fixed by its last piece and the encoding before that piece, and a row of pieces is
an encoding exactly if every two neighbours stay apart when they are encoded together. So the last piece of
each prefix is the one piece that fits the last piece of the shorter prefix, and

    count(prefix) = count(prefix without its last piece) + 1.

All counts are stored, so the count of any prefix, and the longest prefix within a budget, are look-ups.

No piece crosses from a letter to the blank mark after it, nor a character that only stands alone, so a
text falls into units whose counts add up; a unit's counts are computed once per worker memo.
"""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import map_rows, utf8, worker_cache

common.ship(__name__)

MARK = "▁"
MEMO_UNITS = 400_000
LIMIT = 4096


class PrefixCounter:
    """Exact counts for every prefix of a text, for a byte-fallback BPE vocabulary."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.scores = {
            library.id_to_piece(i): library.get_score(i)
            for i in range(library.get_piece_size())
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))
        }
        # Endings of pieces, with whether they are pieces themselves.
        self.endings = {piece[i:]: piece[i:] in self.scores for piece in self.scores for i in range(len(piece))}
        self.units = re.compile(self._units())
        self.memo: dict[str, tuple[int, bytes]] = {}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.trees: dict[str, tuple[str, str] | None] = {}

    def _units(self) -> str:
        """A pattern whose matches no piece crosses: characters that never stand together in a piece part units."""
        joined = {c for piece in self.scores if len(piece) > 1 for c in piece} - {MARK}
        letters = {c for c in joined if c.isalpha()}
        beside = {(a in letters, b in letters) for piece in self.scores for a, b in zip(piece, piece[1:], strict=False) if MARK not in (a, b)}
        kinds = [letters, joined - letters] if not beside & {(True, False), (False, True)} else [joined]
        classes = ["[" + "".join(map(re.escape, sorted(kind))) + "]+" for kind in kinds if kind]
        return "|".join([*(f"{MARK}*{c}" for c in classes), f"{MARK}+", "(?s:.)"])

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text: join the best-scored neighbours, the leftmost first, while any join."""
        symbols = list(text)
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = self.scores.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def tree(self, piece: str) -> tuple[str, str] | None:
        """The two parts of a piece's last join; None if they don't exist or if joins aren't in falling order."""
        if piece not in self.trees:
            symbols, parts, lowest, falling = list(piece), None, float("inf"), True
            while len(symbols) > 1:
                joins = [(self.scores.get(a + b, -float("inf")), -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False))]
                score, at = max(joins)
                if score == -float("inf"):
                    break
                falling, lowest = falling and score <= lowest, score
                parts = (symbols[-at], symbols[1 - at])
                symbols[-at : 2 - at] = ["".join(parts)]
            self.trees[piece] = parts if len(symbols) == 1 and falling else None
        return self.trees[piece]

    def apart(self, left: str, right: str) -> bool | None:
        """Whether no join across the border is ever the best one; None if the order of joins does not tell.

        Joins happen in falling order of score, so they are undone from the last to the first.
        """
        scores = self.scores
        if left + right in scores:
            return False
        while len(left) > 1 or len(right) > 1:
            parts_left = self.tree(left) if len(left) > 1 else None
            parts_right = self.tree(right) if len(right) > 1 else None
            if parts_left is None and len(left) > 1 or parts_right is None and len(right) > 1:
                return None
            by_left = scores[left] if parts_left else float("inf")
            by_right = scores[right] if parts_right else float("inf")
            if by_left < by_right:
                left = parts_left[1]
                if scores.get(left + right, -float("inf")) > by_left:
                    return False
            else:
                right = parts_right[0]
                if scores.get(left + right, -float("inf")) >= by_right:
                    return False
        return True

    def fits(self, before: str, piece: str) -> bool:
        """Whether both stay whole when they stand side by side (or alone, at the start of a unit)."""
        known = self.apart(before, piece) if before in self.scores else None
        if known is None:
            known = self.merged(before + piece) == ([before, piece] if before else [piece])
        self.pairs[before][piece] = known
        return known

    def unit_counts(self, unit: str) -> list[int]:
        """Counts of the unit's prefixes, from one character to all of it."""
        endings, pairs = self.endings, self.pairs
        counts, after = [0], [pairs.setdefault("", {})]
        lasts = [""]
        for end in range(1, len(unit) + 1):
            # One piece fits only, so the order of trials is free.
            start = end - 1
            while start >= 0:
                piece = unit[start:end]
                kind = endings.get(piece)
                if kind:
                    known = after[start].get(piece)
                    if known or known is None and self.fits(lasts[start], piece):
                        break
                elif kind is None:
                    start = -1
                    break
                start -= 1
            if start >= 0:
                counts.append(counts[start] + 1)
            else:
                # A character outside the vocabulary falls back to its bytes.
                piece = unit[end - 1]
                counts.append(counts[end - 1] + len(piece.encode("utf-8")))
            lasts.append(piece)
            row = pairs.get(piece)
            if row is None:
                row = pairs[piece] = {}
            after.append(row)
        return counts[1:]

    def counted(self, units: list[str]) -> dict[str, tuple[int, bytes]]:
        """The memo after it holds these units: the total, and the steps between neighbouring prefixes."""
        memo = self.memo
        if len(memo) > MEMO_UNITS:
            memo.clear()
            self.pairs.clear()
        for unit in {u for u in units if u not in memo}:
            counts = self.unit_counts(unit)
            memo[unit] = (counts[-1], bytes([b - a & 255 for a, b in zip([0, *counts], counts, strict=False)]))
        return memo

    def split(self, text: str) -> list[str]:
        """The units of a text as the library sees it: blanks are marks, and one mark stands before the text."""
        return self.units.findall(MARK + text.replace(" ", MARK)) if text else []

    def count(self, text: str) -> int:
        units = self.split(text)
        memo = self.counted(units)
        return sum([memo[u][0] for u in units])

    def prefixes(self, text: str) -> np.ndarray:
        """Entry i is the number of tokens of the first i characters, encoded on their own."""
        if not text:
            return np.zeros(1, np.int64)
        units = self.split(text)
        memo = self.counted(units)
        steps = np.frombuffer(b"".join([memo[u][1] for u in units]), dtype=np.int8)
        counts = np.cumsum(steps, dtype=np.int64)
        counts[0] = 0  # the mark alone: no text, no tokens
        return counts


def counter(path: str) -> PrefixCounter:
    memo = worker_cache("token-counts")
    if path not in memo:
        memo[path] = PrefixCounter(path)
    return memo[path]


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """The number of characters of the longest prefix with at most ``budget`` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1])


def count_tokens(
    docs: DataFrame,
    path: str | None = None,
    budget: int = LIMIT,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_prefixes: bool = False,
) -> DataFrame:
    """Exact token counts of whole texts; one row per row of ``docs``, other columns are ignored.

    ``budget_chars`` is the length of the longest prefix within the budget. With ``keep_prefixes`` the
    counts of all prefixes are returned as well (entry i: the first i characters), for later questions.
    A missing text counts as empty: no bytes, no tokens. Repeated rows and missing ids stay as they are.
    """
    path = path or public_tokenizers.path("piece_bpe_32k.model")

    def work(rows: dict[str, list]) -> dict[str, list]:
        count = counter(path)
        out: dict[str, list] = {"doc_id": rows["doc_id"], "n_bytes": [], "n_tokens": [], "budget_chars": [], "prefix_tokens": []}
        for raw in rows["text"]:
            prefixes = count.prefixes(raw.decode("utf-8"))
            out["n_bytes"].append(len(raw))
            out["n_tokens"].append(int(prefixes[-1]))
            out["budget_chars"].append(longest_prefix(prefixes, budget))
            out["prefix_tokens"].append(prefixes.tolist() if keep_prefixes else None)
        return out

    counted = map_rows(
        docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), utf8(text_column).alias("text")),
        work,
        "doc_id long, n_bytes long, n_tokens long, budget_chars long, prefix_tokens array<long>",
    )
    counted = counted.withColumn("over_limit", F.col("n_tokens") > budget)
    return counted if keep_prefixes else counted.drop("prefix_tokens")
