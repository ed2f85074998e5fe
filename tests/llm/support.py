"""Small tables with the awkward cases, shared by the tests of this folder."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, component long, rest string, found string"

EN = "the thing of which he was and they are with this".split()
FR = "les élèves que nous avons été où ça être français".split()


def text(seed: int, words: list[str], count: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "er", "."]) for _ in range(count))


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows; columns with clashing names."""
    extra = ("k", 1, "r", "f")
    long = text(1, EN, 30_000)
    rows = [
        (1, text(2, EN, 40), "en", "src1", 3, *extra),
        (2, text(3, FR, 40), "fr", "src2", 3, *extra),
        (3, None, "en", "src1", None, *extra),
        (4, "", None, None, 0, *extra),
        (5, " \n\t ", "en", "src3", 4, None, None, None, None),
        (6, long, "en", "src1", len(long), *extra),
        (7, "same tie text here", "en", "src1", 18, *extra),
        (8, "same tie text here", "en", "src1", 18, *extra),
        (9, "same tie text here", "en", "src1", 18, *extra),
        (9, "same tie text here", "en", "src1", 18, *extra),
        (None, text(4, EN, 30), "en", "src2", 3, *extra),
        (None, None, None, None, None, None, None, None, None),
        (10, "12345 -- 67 !!", "en", "src4", 14, *extra),
        (11, "漢字かな交じり文 привет мир \U0001f600 naïve", "en", "nosource", 3, *extra),
    ]
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA)


def documents(spark, texts, **columns):
    rows = [(i, t, columns.get("lang", "en"), f"src{i % 3}", len(t or ""), "k", 1, "r", "f") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)
