"""Quality rules and robust multivariate outliers; DataFrame functions only.

Every text gets counts (words, characters in words, symbols, repeated lines, words
in repeated windows) and fails the base rules if it has too few words or too many
of them in repeated windows. From the counts come four transformed statistics: log of the
mean word length, and asinh of symbols, repeated lines and repeated words per
hundred. Per language and source a minimum-covariance-determinant estimate describes
the three quarters of the documents that lie closest together, and a document whose
squared Mahalanobis distance from it exceeds the cutoff is rejected.

The estimate takes concentration steps from two starts (component medians with a fixed
scale, and plain moments of all rows) and keeps, per group, the one whose
covariance has the smaller determinant. A step is one pass over the slim statistics
table: rows are put into bins of log distance, the moments of each (group, bin) are
summed before the shuffle, and the lowest bins that hold three quarters of the group
give the next estimate. A group's size therefore never shows in a task, and results
do not depend on the order of rows. Variances have a floor, as most documents have no
symbols or repeats at all; distances are scaled so that each group's median is that
of the chi-square law.

Every group shrinks towards its language and every language towards all documents: the parent's
moments count as `PRIOR` more rows that lie closest, so three quarters of the rows and the
prior hold the prior first and the group's nearest rows after it. A group of a few documents is
judged by its language, which its own documents cannot shift, a large one by itself, and
nothing changes at any one size. Null languages and sources are groups of their
own. Null and empty texts have zero counts and fail the base rules. Repeated rows count
and are judged each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.llm.common import SPACE_CLASS, text_of
from stockweave.session import settle_table

SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent

# rows that the parent's moments weigh
PRIOR = 50.0
SUBSET = 0.75
STEPS = 4
# floor of a standard deviation, per statistic: where a group has no repeated lines, a share of two
# thirds exceeds the cutoff alone; repeated words have a base rule and only add to the distance
FLOORS = (0.08, 0.25, 0.7, 1.0)
P = len(FLOORS)
# median of the chi-square law with 4 degrees of freedom, and the point that one in a billion exceeds
MEDIAN_CHI2 = 3.357
CUTOFF = 48.0
# bins of the logarithm of a squared distance, per unit
_FINE = 16
_PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def _let(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _total(items: Column) -> Column:
    return F.aggregate(items, F.lit(0), lambda a, x: (a + x).cast("int"))


def _repeated_words(words: Column) -> Column:
    """Words in windows of eight that occur twice or more."""

    def covered(pairs: Column) -> Column:
        def again(p, i):
            return (p["h"] == F.get(pairs, i - 1)["h"]) | (p["h"] == F.get(pairs, i + 1)["h"])

        at = F.array_sort(F.transform(F.filter(pairs, lambda p, i: F.coalesce(again(p, i), F.lit(False))), lambda p: p["i"]))
        # a window reaches to the start of the next one at most
        return _let(at, lambda s: _total(F.transform(s, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(s, j + 1) - p, F.lit(WINDOW))))))

    def count(windows: Column) -> Column:
        # sorting (hash, place) brings equal windows together; most texts have none
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_let(pairs, covered))

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, F.lit(WINDOW))))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    counted = _let(hashes, lambda h: _let(windows(h), count))
    return F.when(F.size(words) > WINDOW, counted).otherwise(F.lit(0)).cast("long")


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines and base_failed."""
    rows = docs.select("doc_id", F.col("lang").cast("string"), F.col("source").cast("string"), text_of().alias("text"))
    bare = F.btrim("text", F.lit(SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE_CLASS}]+"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    split = rows.select("doc_id", "lang", "source", "text", words.alias("words"), lines.alias("lines"))
    counted = split.select(
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def statistics() -> Column:
    """The transformed vector; all zero where there are no words."""

    def per_hundred(count: str, of: str) -> Column:
        return F.asinh(F.lit(100.0) * F.col(count) / F.greatest(F.col(of), F.lit(1)))

    length = F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1)))
    return F.array(length, per_hundred("n_symbols", "n_words"), per_hundred("n_dup_lines", "n_lines"), per_hundred("n_repeat_words", "n_words"))


# the estimate over all documents
EVERY = "all"


def _grouped(counted: DataFrame) -> DataFrame:
    """Add `group` (language and source) and `parent` (language)."""
    parent = F.to_json(F.struct("lang", F.lit(True).alias("pool")))
    return counted.withColumns({"group": F.to_json(F.struct("lang", "source")), "parent": parent})


def _parents(rows: DataFrame) -> DataFrame:
    """group and parent of every group that has one."""
    own = rows.select("group", "parent").distinct()
    return own.unionByName(own.select(F.col("parent").alias("group"), F.lit(EVERY).alias("parent")).distinct())


def _estimates(moments: DataFrame) -> DataFrame:
    """group, start, mean, precision (packed), logdet and means of `_MOMENTS` from sums n, s0.., q00.. per group and start."""
    n = F.col("n")
    average = F.array(*[F.col(c) / n for c in _MOMENTS])
    table = moments.withColumn("moments", average).withColumns({f"m{i}": F.col(f"s{i}") / n for i in range(P)})
    for i, j in _PAIRS:
        value = F.col(f"q{i}{j}") / n - F.col(f"m{i}") * F.col(f"m{j}")
        value = F.greatest(value, F.lit(0.0)) + FLOORS[i] ** 2 if i == j else value
        table = table.withColumn(f"c{i}{j}", value)
    # Cholesky factor and its inverse, a column per entry
    for i, j in _PAIRS:
        rest = F.col(f"c{i}{j}") - reduce(lambda a, b: a + b, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.lit(0.0))
        table = table.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l{j}{j}"))
    for j in range(P):
        for i in range(j, P):
            done = reduce(lambda a, b: a + b, [F.col(f"l{i}{k}") * F.col(f"v{k}{j}") for k in range(j, i)], F.lit(0.0))
            table = table.withColumn(f"v{i}{j}", (F.lit(1.0 if i == j else 0.0) - done) / F.col(f"l{i}{i}"))
    precision = [reduce(lambda a, b: a + b, [F.col(f"v{k}{i}") * F.col(f"v{k}{j}") for k in range(i, P)]) for i, j in _PAIRS]
    return table.select(
        "group",
        "start",
        F.array(*[f"m{i}" for i in range(P)]).alias("mean"),
        F.array(*precision).alias("precision"),
        reduce(lambda a, b: a + b, [F.log(f"l{i}{i}") for i in range(P)]).alias("logdet"),
        "moments",
    )


def _distance() -> Column:
    """Squared Mahalanobis distance of `x` from `mean` under `precision`."""
    gap = [F.get("x", F.lit(i)) - F.get("mean", F.lit(i)) for i in range(P)]
    parts = [F.get("precision", F.lit(k)) * gap[i] * gap[j] * (1.0 if i == j else 2.0) for k, (i, j) in enumerate(_PAIRS)]
    return reduce(lambda a, b: a + b, parts)


def _bin(distance: Column) -> Column:
    return F.floor(F.log(F.greatest(distance, F.lit(1e-6))) * _FINE).cast("int")


def _sums() -> list[Column]:
    x = [F.get("x", F.lit(i)) for i in range(P)]
    return [
        F.count("*").alias("n"),
        *[F.sum(x[i]).alias(f"s{i}") for i in range(P)],
        *[F.sum(x[i] * x[j]).alias(f"q{i}{j}") for i, j in _PAIRS],
    ]


_MOMENTS = [*[f"s{i}" for i in range(P)], *[f"q{i}{j}" for i, j in _PAIRS]]
_SUMS = ["n", *_MOMENTS]


def _shrunk(sums: DataFrame, priors: DataFrame) -> DataFrame:
    """`sums` (group, start, `_SUMS`) with `weight` more rows that have the averages `prior`."""
    weight = F.coalesce("weight", F.lit(0.0))
    more = {c: F.col(c) + weight * F.coalesce(F.get("prior", F.lit(k)), F.lit(0.0)) for k, c in enumerate(_MOMENTS)}
    return sums.join(priors, ["group", "start"], "left").withColumns({"n": F.col("n") + weight, **more}).drop("prior", "weight")


def _priors(fit: DataFrame, parents: DataFrame) -> DataFrame:
    """group, start, prior and weight: the averages of the parent's present estimate."""
    above = fit.select(F.col("group").alias("parent"), "start", F.col("moments").alias("prior"))
    return parents.join(above, "parent").select("group", "start", "prior", F.lit(PRIOR).alias("weight"))


def _lowest(bins: DataFrame, keys: list[str], share: float, held: Column | None = None) -> DataFrame:
    """The bins (rows with `bin` and `n`) that hold the lowest `share` of each group and of `held` rows below all bins."""
    held = F.lit(0.0) if held is None else held
    upto = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    ranked = bins.withColumn("_below", F.coalesce(F.sum("n").over(upto), F.lit(0))).withColumn("_all", F.sum("n").over(whole))
    return ranked.filter(F.col("_below") + held < (F.col("_all") + held) * F.lit(share)).drop("_below", "_all")


def _starts(rows: DataFrame) -> DataFrame:
    """Two first estimates per group; the moments of both are those of all rows."""
    cells = rows.select("group", F.posexplode("x").alias("part", "value"))
    counts = cells.groupBy("group", "part", F.floor(F.col("value") * 100).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    middle = _lowest(counts, ["group", "part"], 0.5).groupBy("group", "part").agg(F.max("bin").alias("bin"))
    medians = middle.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("part", "bin"))).alias("at"))  # four entries
    fixed = [F.lit(1 / (3 * f) ** 2 if i == j else 0.0) for (i, j) in _PAIRS for f in [FLOORS[i]]]
    by_median = medians.select(
        "group",
        F.lit(0).alias("start"),
        F.transform("at", lambda s: (s["bin"] + 0.5) / 100).alias("mean"),
        F.array(*fixed).alias("precision"),
        F.lit(0.0).alias("logdet"),
    )
    plain = _estimates(rows.groupBy("group").agg(*_sums()).withColumn("start", F.lit(1)))
    return by_median.join(plain.select("group", "moments"), "group").unionByName(plain)


def _scales(own: DataFrame, parents: DataFrame) -> DataFrame:
    """group and scale from group, rows and log (of its own scale), shrunk towards the parent's and its parent's."""
    up = own.join(parents, "group", "left")
    above = up.select(F.col("group").alias("parent"), F.col("parent").alias("top"), F.col("rows").alias("_rows"), F.col("log").alias("_log"))
    highest = own.select(F.col("group").alias("top"), F.col("log").alias("_top"))
    table = up.join(above, "parent", "left").join(highest, "top", "left")

    def towards(log: Column, rows: Column, other: Column) -> Column:
        return F.when(other.isNull(), log).otherwise((log * rows + other * PRIOR) / (rows + PRIOR))

    parent = towards(F.col("_log"), F.col("_rows"), F.col("_top"))
    return table.select("group", F.exp(towards(F.col("log"), F.col("rows"), parent)).alias("scale"))


def robust_estimates(rows: DataFrame, parents: DataFrame | None = None, steps: int = STEPS) -> DataFrame:
    """group, mean, precision and scale of every group of `rows` (group, x), shrunk towards those `parents` (group, parent) names.

    A parent is a group of `rows` itself; a chain has two parents at most.
    """
    if parents is None:
        parents = rows.sparkSession.createDataFrame([], "group string, parent string")
    keys = ["group", "start"]
    fit = settle_table(_starts(rows), "quality-fit")
    for _ in range(steps):
        priors = _priors(fit, parents)
        placed = rows.select("group", "x").join(fit, "group").withColumn("bin", _bin(_distance()))
        bins = placed.groupBy(*keys, "bin").agg(*_sums()).join(priors.select(*keys, "weight"), keys, "left")
        near = _lowest(bins, keys, SUBSET, F.coalesce("weight", F.lit(0.0)))
        near = near.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS])
        # where the prior fills the three quarters no row of the group is left
        near = fit.select(*keys).join(near, keys, "left").fillna(0.0, _SUMS)
        fit = settle_table(_estimates(_shrunk(near, priors)), "quality-fit")
    best = fit.groupBy("group").agg(F.min_by(F.struct("mean", "precision"), F.struct("logdet", "start")).alias("e"))
    best = settle_table(best.select("group", "e.*"), "quality-fit")
    bins = rows.select("group", "x").join(best, "group").groupBy("group", _bin(_distance()).alias("bin")).agg(F.count("*").alias("n"))
    middle = _lowest(bins, ["group"], 0.5).groupBy("group").agg(F.max("bin").alias("bin"))
    # where most rows coincide the median says nothing about the spread: never below that of the law
    log = F.greatest((F.col("bin") + 0.5) / _FINE - math.log(MEDIAN_CHI2), F.lit(0.0))
    own = middle.select("group", log.alias("log")).join(bins.groupBy("group").agg(F.sum("n").alias("rows")), "group")
    return settle_table(best.join(_scales(settle_table(own, "quality-scale"), parents), "group"), "quality-fit")


def judge_quality(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The counts of every row of `docs` (doc_id, text, lang, source), base_failed, distance and kept."""
    counted = settle_table(text_counts(docs), "quality-counts")
    rows = _grouped(counted.withColumn("x", statistics()))
    worded = rows.filter("n_words > 0")
    parents = settle_table(_parents(worded), "quality-groups")
    levels = settle_table(worded.select(F.explode(F.array("group", "parent", F.lit(EVERY))).alias("group"), "x"), "quality-rows")
    fit = robust_estimates(levels, parents)
    distance = F.when(F.col("n_words") > 0, _distance() / F.col("scale"))
    judged = rows.join(fit, "group", "left").withColumn("distance", distance)
    outlier = F.coalesce(F.col("distance") > cutoff, F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~outlier).drop("group", "parent", "x", "mean", "precision", "scale")
