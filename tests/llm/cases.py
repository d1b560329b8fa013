"""Rows that every operator on documents must take: nulls, empty and long texts, repeats, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
SPACES = " \t\n\x0b\x0c\r"


def words(rnd: random.Random, n: int) -> list[str]:
    return ["".join(rnd.choice("abcdefg") for _ in range(rnd.randint(1, 6))) for _ in range(n)]


def documents(spark: SparkSession, seed: int = 3, n: int = 40) -> DataFrame:
    """Ordinary rows, copies and near copies, and the odd ones."""
    rnd = random.Random(seed)
    texts: list[str | None] = [" ".join(words(rnd, rnd.randint(5, 120))) for _ in range(n)]
    texts += texts[:5]
    for text in texts[:5]:
        changed = text.split(" ")
        changed[len(changed) // 2] = "zzz"
        texts.append(" ".join(changed))
    texts += [None, "", " \t\n ", "é▁ 漢\x00字 \n\n\x0b", " ".join(words(rnd, 6000))]
    rows = [(i, t, rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "z", None]), len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, "no id", "en", "a", 5), (None, None, None, None, None), rows[0], rows[0], (1, texts[2], "en", "a", 1)]
    return spark.createDataFrame(rows, COLUMNS)


def with_clashes(docs: DataFrame) -> DataFrame:
    """More columns, named like those that operators make on their way."""
    names = ("row_id", "copies", "size", "score", "predicted", "spans", "kinds", "text_key", "fp", "component", "ids", "word", "group", "x", "doc")
    return docs.withColumns({name: F.lit("clash") for name in names})


def empty(docs: DataFrame) -> DataFrame:
    return docs.limit(0)
