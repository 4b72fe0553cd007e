"""Small tables with every awkward row, and plain re-statements of the operators."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, places string, n int, path string, digest string"

WORDS = "the of river stone amber quiet lantern harbour meadow velvet copper falcon timber orchard glacier saddle thunder willow marble candle".split()


def sentence(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "s", "ly", "er"]) for _ in range(n)) + "."


def awkward_rows(seed: int = 7) -> list[tuple]:
    """(doc_id, text, lang, source): nulls, empty and long texts, copies, near copies, repeated rows."""
    rnd = random.Random(seed)
    rows = [(i, sentence(rnd, rnd.randint(3, 90)), rnd.choice(["en", "de"]), f"s{i % 3}") for i in range(10, 60)]
    base = sentence(rnd, 120).split()
    for k in range(6):
        near = list(base)
        for _ in range(k):
            near[rnd.randrange(len(near))] = "changed"
        rows.append((100 + k, " ".join(near), "en", "s0"))
    shared = sentence(rnd, 30)
    rows += [(200 + k, f"{sentence(rnd, 9)} {shared}\n{sentence(rnd, 12)}", "en", "s0") for k in range(8)]
    rows += [(300 + k, "same text for many rows, again and again", "en", "s0") for k in range(5)]
    rows += [(1, None, None, None), (2, "", "en", "s1"), (3, " \n\t ", "en", None), (4, "word", "en", "s1"), (5, "ÄÖ çé 中文 😀 naïve", "de", "s2"), (None, "a text without an id but with words", "en", "s1")]
    rows += [(6, " ".join(sentence(rnd, 15) for _ in range(400)), "en", "s1"), (7, "x" * 5000, "en", "s1"), (8, "1 2 3 !!! ...", "en", "s1")]
    rows += [(9, rows[0][1], "en", "s1"), rows[0], rows[0]]
    return rows


def frame(spark: SparkSession, rows: list[tuple], parts: int = 3) -> DataFrame:
    """The rows as documents, with further columns whose names clash with inner ones."""
    full = [(d, t, lang, s, None if t is None else len(t), -1, "k", "p", 0, "x", "y") for d, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def alnum_words(text: str | None) -> list[str]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
