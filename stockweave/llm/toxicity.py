"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding undoes disguises one character at a time: compatibility forms, invisible
characters, letters of other scripts that look Latin, digits and signs that stand
for letters. Everything else that is no letter becomes a space. `i`, `l`, `1`, `|`
and `!` look alike and fold to `i`, in the lexicon too.

Lexicon entries are whole words or beginnings of words, with a weight. One
automaton finds all of them and all exception phrases in one pass; a match inside
an exception phrase does not count. The sum of weights, divided by the square root
of the number of words, goes through a logistic curve.

`learn` takes entries, weights and curve from labelled documents: entry weights
are log ratios of rates of occurrence in the two classes, and of entries that
begin alike only the one that separates the classes best stays. Learning uses at
most `MAX_TRAIN` labelled rows, the first by hash of doc_id. The counts come from an
aggregate over tasks, which also drops entries that do not separate the classes beyond chance
(`LEAST_ROOT`); the driver sees those of the bounded sample that do, and a histogram.

A null or empty text has no matches and scores as such. A null doc_id has no label.
Repeated rows are scored each; a document labelled twice is toxic if any label says
so; null labels are ignored. Without toxic training rows every score is 0. An empty
table gives no rows; columns other than doc_id, text (and toxic) are not read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import text_of
from stockweave.session import settle_table

MAX_TRAIN = 10_000
# shortest and longest beginning of a word that can be an entry
SHORTEST, LONGEST = 3, 8
# least documents with an entry, least log ratio, least signed root of the likelihood ratio
LEAST_DOCS, LEAST_RATIO, LEAST_ROOT = 4, 1.2, 4.0
# an entry gives way to one that continues it and reaches this part of its root
AS_GOOD = 0.93
LENGTH_OFFSET = 10
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "pond scum", "loser bracket", "stupid question")

# letters of other scripts that look like Latin ones (fixed values)
_LOOKALIKE = str.maketrans(
    "абвгдеёзийкмнорстухіїјѕѵԁһԛԝαβεηικνορτυχωγɑɡı",
    "abbrdeezuukmhopctyxiijsvdhqwabenikvoptuxwyagi",
)
_INVISIBLE = re.compile(r"[\u00ad\u200b-\u200f\u2060-\u2064\ufe00-\ufe0f\ufeff]")
_OTHER_SCRIPT = re.compile(r"[\u0131\u0251\u0261\u0370-\u052f]")
_SIGNS = re.compile(r"[\u0080-\u00bf\u00d7\u00f7\u2000-\u2bff\u3000-\u303f]+")
_LOOSE = re.compile(r"[$@!|]+(?![a-z0-9])")
_FROM, _TO = b"0134578@$!|l", b"oieastbasiii"
_ASCII = bytearray(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
for _a, _b in zip(_FROM, _TO):
    _ASCII[_a] = _b
_ASCII = bytes(_ASCII)


def fold(text: str | None) -> list[bytes]:
    """The words of the text, folded; as UTF-8."""
    if not text:
        return []
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text)).lower()
        if _OTHER_SCRIPT.search(text):
            text = text.translate(_LOOKALIKE)
        text = _SIGNS.sub(" ", text)
    text = _LOOSE.sub(" ", text.lower())
    return text.encode("utf-8", "replace").translate(_ASCII).split()


def _padded(words: list[bytes]) -> str:
    # one character per byte, so that the automaton works on bytes
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


@dataclass(frozen=True)
class Lexicon:
    """`entries` are folded: ` word ` for a word, ` beg` for the beginning of words."""

    entries: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = 1.0
    intercept: float = -3.0
    _made: list = field(default_factory=list, compare=False, repr=False)

    def automaton(self):
        if not self._made:
            found = ahocorasick.Automaton()
            for entry, weight in self.entries:
                found.add_word(entry, (weight, len(entry)))
            for phrase in self.exceptions:
                key = _padded(fold(phrase))
                if key not in found:
                    found.add_word(key, (None, len(key)))
            found.make_automaton()
            self._made.append(found)
        return self._made[0]

    def __getstate__(self):
        return {**self.__dict__, "_made": []}

    def measure(self, words: list[bytes]) -> tuple[float, int]:
        """Sum of the weights of the matches that count, and their number."""
        if not words or not self.entries:
            return 0.0, 0
        hits, shields = [], []
        for end, (weight, length) in self.automaton().iter(_padded(words)):
            (shields if weight is None else hits).append((end - length + 1, end, weight))
        if shields:
            # a beginning of a word has no space at its end, so compare starts and ends
            hits = [h for h in hits if not any(s[0] <= h[0] and h[1] <= s[1] for s in shields)]
        return sum(h[2] for h in hits), len(hits)

    def strength(self, words: list[bytes]) -> float:
        return self.measure(words)[0] / math.sqrt(len(words) + LENGTH_OFFSET)

    def score(self, strength: float) -> float:
        x = self.intercept + self.slope * math.log1p(max(strength, 0.0))
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def _features(word: bytes) -> Iterator[str]:
    text = word.decode("utf-8", "replace")
    yield f" {text} "
    for n in range(SHORTEST, min(LONGEST, len(text) - 1) + 1):
        yield f" {text[:n]}"


def _count_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per feature: documents and occurrences in each class, summed over what the task has read."""
    sums: dict[str, list[int]] = {}

    def out() -> pd.DataFrame:
        frame = pd.DataFrame.from_dict(sums, orient="index", columns=["d0", "d1", "c0", "c1"])
        return frame.rename_axis("feature").reset_index()

    for rows in batches:
        for text, toxic in zip(rows["text"], rows["toxic"]):
            words = Counter(fold(text))
            seen: Counter = Counter()
            for word, n in words.items():
                for feature in _features(word):
                    seen[feature] += n
            # the empty feature counts documents and words
            seen[""] = sum(words.values())
            for feature, n in seen.items():
                row = sums.setdefault(feature, [0, 0, 0, 0])
                row[toxic] += 1
                row[2 + toxic] += n
        if len(sums) > 300_000:
            yield out()
            sums.clear()
    if sums:
        yield out()


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN) -> DataFrame:
    """Texts and labels (text, toxic) of at most `max_rows` labelled documents."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    # at most max_rows rows of two numbers
    return docs.select("doc_id", text_of().alias("text")).join(F.broadcast(known), "doc_id").drop("doc_id")


def _separates(n0: int, n1: int) -> Column:
    """Signed root of the likelihood ratio of two binomials, from d0 of n0 and d1 of n1 documents."""
    d0, d1 = F.col("d0"), F.col("d1")
    rate = (d0 + d1) / (n0 + n1)
    terms = [
        F.when((seen > 0) & F.lit(n > 0), seen * F.log(seen / (n * share))).otherwise(0.0)
        for d, n in ((d0, n0), (d1, n1))
        for seen, share in ((d, rate), (n - d, 1 - rate))
    ]
    root = F.sqrt(F.greatest(F.lit(0.0), 2 * sum(terms, F.lit(0.0))))
    return F.when(d1 / max(n1, 1) >= d0 / max(n0, 1), root).otherwise(-root)


def _fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve with a weak pull to zero."""
    beta = np.array([0.0, 0.0])
    design = np.stack([np.log1p(np.maximum(x, 0)), np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - 0.01 * beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def learn(training: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """A lexicon from `training` (text, toxic 0 or 1)."""
    training = settle_table(training, "toxic-training")
    counts = training.mapInPandas(_count_features, "feature string, d0 long, d1 long, c0 long, c1 long")
    sums = settle_table(
        counts.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("d0", "d1", "c0", "c1")]).filter(f"d1 >= {LEAST_DOCS}"),
        "toxic-features",
    )
    total = sums.filter("feature = ''").first()
    if total is None:
        return Lexicon((), exceptions, 0.0, -1000.0)
    n0, n1, w0, w1 = total["d0"], total["d1"], total["c0"], total["c1"]
    ratio = F.log((F.col("c1") + 0.5) / (w1 + 1.0)) - F.log((F.col("c0") + 0.5) / (w0 + 1.0))
    best = (
        sums.filter("feature != ''")
        .select("feature", ratio.alias("ratio"), _separates(n0, n1).alias("root"))
        .filter((F.col("ratio") >= LEAST_RATIO) & (F.col("root") >= AS_GOOD * LEAST_ROOT))
        .collect()
    )
    ranked = sorted(((r["root"], r["feature"], r["ratio"]) for r in best), key=lambda r: (-r[0], r[1]))
    chosen: list[tuple[str, float]] = []
    for root, feature, weight in ranked:
        bare = feature.rstrip()
        nested = any(bare.startswith(c.rstrip()) or c.startswith(bare) for c, _ in chosen)
        if root < LEAST_ROOT or nested:
            continue
        # the most specific entry that does as well: `trash` and not `tra`
        longer = [r for r in ranked if r[1].startswith(bare) and r[0] >= AS_GOOD * root]
        _, feature, weight = max(longer, key=lambda r: (len(r[1]), r[0], r[1]))
        chosen.append((feature, weight))
    draft = Lexicon(tuple((f.encode().decode("latin-1"), w) for f, w in sorted(chosen)), exceptions)

    def strengths(batches):
        for rows in batches:
            yield pd.DataFrame({"x": [round(draft.strength(fold(t)), 2) for t in rows["text"]], "toxic": rows["toxic"]})

    bins = training.mapInPandas(strengths, "x double, toxic int").groupBy("x", "toxic").count().toPandas()
    slope, intercept = _fit_curve(*[bins[c].to_numpy(dtype=float) for c in ("x", "toxic", "count")])
    return Lexicon(draft.entries, exceptions, slope, intercept)


def score_toxicity(docs: DataFrame, lexicon: Lexicon, key: str = "doc_id") -> DataFrame:
    """key, score double, predicted int, n_hits int for every row of `docs` (key, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            scores, hits = [], []
            for text in rows["text"]:
                words = fold(text)
                total, n = lexicon.measure(words)
                scores.append(lexicon.score(total / math.sqrt(len(words) + LENGTH_OFFSET)))
                hits.append(n)
            yield pd.DataFrame(
                {key: rows[key], "score": scores, "predicted": [int(s >= 0.5) for s in scores], "n_hits": hits}
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text_of().alias("text")).mapInPandas(
        run, f"`{key}` {kind}, score double, predicted int, n_hits int"
    )


def drop_toxic(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows of `docs` whose text scores below one half, with all their columns; only texts go to Python."""

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([lexicon.score(lexicon.strength(fold(t))) < 0.5 for t in texts], dtype=bool)

    return docs.filter(clean(text_of()))


def held_out(folds: int = 5):
    """Rows that learning must not see: crc32 of doc_id as text is a multiple of `folds`."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False))
