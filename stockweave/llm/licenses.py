"""License scans by diagonal voting; DataFrame functions only.

Templates are short phrases, statements and notices. Every text gives a hash for each
run of k words (k = 2 for templates marked `base`, 4 or the template's length for the
others), and one join brings the hashes to the positions of the same runs in the
templates; the words themselves are compared there, so a clash of hashes costs nothing.
A hit votes for the diagonal `word position - template position`, the place where the
template would begin. Votes are summed per text, template and diagonal. Diagonals
that lie next to each other (a word was added or lost between them) are merged, and a
span is accepted if its hits cover the template's share `least` of words and it is not
much longer than the template; else a single diagonal may still be accepted alone.
Templates with `least` 1 are accepted on one diagonal only, with every run in place, so
they stand there word for word.

The template side is bounded by the parameter `templates`. Up to `LISTED_RUNS` words it is
broadcast, and a text's runs are looked up in the set of its hashes before they become
rows; beyond, all runs are joined over a shuffle. A text's hits are no more than its words times the largest number
of equal runs in a template, and what one task sorts is the diagonals of one text.
Texts are read once and neither shuffled nor written; the table of hits has one row per
text besides the hits.

A-Z are lower-cased, other letters stay. Null and empty texts have no words, no places and
score 0. Rows need no unique doc_id: repeated rows and null ids are scanned each. Places
of a phrase may overlap. Labels are sorted by code point; no label gives the empty
string, no place null positions. An empty table gives no rows; columns other than doc_id
and text are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockweave.llm.common import text_of
from stockweave.session import settle_table

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE_RUN = 2
RUN = 4
LEAST = 0.8
# a merged span may exceed its template by this share of its words
STRETCH = 0.25
# up to so many words of all templates, their hashes travel with the plan
LISTED_RUNS = 20_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    least: float = LEAST
    base: bool = False

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(SEPARATORS, self.text.translate(str.maketrans(UPPER, LOWER))) if w]

    @property
    def run(self) -> int:
        return min(BASE_RUN if self.base else RUN, len(self.words))

    @property
    def shift(self) -> int:
        """Diagonals this far apart belong together."""
        return min(8, len(self.words) // 4) if self.least < 1 else 0


# fixed values: the phrases of the contract
PHRASES = (
    Template("gpl", "gnu general public license", 1.0, True),
    Template("apache", "apache license", 1.0, True),
    Template("cc-by", "cc by", 1.0, True),
    Template("mit", "mit license", 1.0, True),
)
# statements of a version, to be found word for word
STATEMENTS = (
    Template("gpl-2.0", "GNU General Public License, version 2", 1.0),
    Template("gpl-3.0", "GNU General Public License, version 3", 1.0),
    Template("apache-2.0", "Apache License, Version 2.0", 1.0),
    Template("cc-by-4.0", "CC BY 4.0", 1.0),
    Template("cc-by-sa-4.0", "CC BY-SA 4.0", 1.0),
    Template("cc-by-nc-4.0", "CC BY-NC 4.0", 1.0),
    Template("cc-by-nd-4.0", "CC BY-ND 4.0", 1.0),
    Template("cc-by", "licensed under a Creative Commons Attribution", 1.0),
    Template("cc0", "CC0 1.0 Universal", 1.0),
)
# notices as their publishers word them
NOTICES = (
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the Software), to deal in the Software without restriction, including"
        " without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"
        " copies of the Software",
    ),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation",
    ),
    Template(
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)
TEMPLATES = PHRASES + STATEMENTS + NOTICES


def _let(value: Column, use) -> Column:
    """`use` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _run_hash(hashes: Column, at: Column, k: int) -> Column:
    # element by element: a slice would copy the whole array for every run
    return F.xxhash64(*[F.get(hashes, at + j) for j in range(k)])


def every_row() -> Column:
    return F.struct(F.lit(0).alias("pos"), F.lit(0).alias("k"), F.lit(0).cast("long").alias("h"))


def _runs(hashes: Column, k: int, wanted: list[int] | None) -> Column:
    """Array of (pos, k, h) of every run of k words, or of those whose hash is `wanted`."""
    starts = F.sequence(F.lit(0), F.size(hashes) - k)
    if wanted is not None:
        starts = F.filter(starts, lambda i: _run_hash(hashes, i, k).isin(wanted))
    found = F.transform(starts, lambda i: F.struct(i.alias("pos"), F.lit(k).alias("k"), _run_hash(hashes, i, k).alias("h")))
    return F.when(F.size(hashes) >= k, found).otherwise(F.array().cast("array<struct<pos:int,k:int,h:bigint>>"))


def _template_runs(spark: SparkSession, templates: tuple[Template, ...], sizes: list[int]) -> DataFrame:
    """tk, h, template (its number), at and the words of every run of the templates, and one row of k 0 that every text meets."""
    listed = [F.struct(F.lit(n).alias("template"), F.lit(t.run).alias("tk"), F.lit(" ".join(t.words)).alias("words")) for n, t in enumerate(templates)]
    rows = spark.range(1).select(F.inline(F.array(*listed))).withColumn("words", F.split("words", " "))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    chosen = F.array(every_row())

    def every_run(k: int):
        return lambda h: _runs(h, k, None)

    for k in sizes:
        chosen = F.when(F.col("tk") == k, _let(hashes, every_run(k))).otherwise(chosen)
    runs = rows.filter("tk > 0").select("template", "words", F.inline_outer(chosen))
    run = F.slice("words", F.col("pos") + 1, F.col("k"))
    marker = spark.range(1).select(F.lit(0).alias("tk"), F.lit(0).cast("long").alias("h"), F.lit(-1).alias("template"), F.lit(0).alias("at"), F.array().cast("array<string>").alias("run"))
    return runs.select(F.col("k").alias("tk"), "h", "template", F.col("pos").alias("at"), run.alias("run")).unionByName(marker)


def text_words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased."""
    # lower() is cheap and the same for texts of one byte a character
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.filter(F.split(low, SEPARATORS), lambda w: w != "")


def template_hits(docs: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """row_id, template, diagonal and at of every hit, and per row one with template -1, doc_id and n_words."""
    sizes = sorted({t.run for t in templates} - {0})
    known = _template_runs(docs.sparkSession, templates, sizes)
    wanted = None
    if sum(len(t.words) for t in templates) <= LISTED_RUNS:
        known, listed = F.broadcast(known), known.select("tk", "h").distinct().collect()  # as many as the templates have words
        wanted = {k: [r["h"] for r in listed if r["tk"] == k] for k in sizes}
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row_id"), text_words(text_of()).alias("words"))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    runs = _let(hashes, lambda h: F.concat(F.array(every_row()), *[_runs(h, k, wanted and wanted[k]) for k in sizes]))
    # the outer form, as the plain one evaluates its array twice; every row has an element
    placed = rows.select("doc_id", "row_id", "words", F.inline_outer(runs))
    met = placed.join(known, "h").filter("k = tk")
    once = F.col("k") == 0
    same = once | (F.slice("words", F.col("pos") + 1, F.greatest("k", F.lit(1))) == F.col("run"))
    hits = met.filter(same).select(
        "row_id",
        F.when(once, F.col("doc_id")).alias("doc_id"),
        F.when(once, F.size("words")).cast("long").alias("n_words"),
        "template",
        (F.col("pos") - F.col("at")).alias("diagonal"),
        "at",
    )
    return settle_table(hits, "license-hits")


def _facts(templates: tuple[Template, ...], value) -> Column:
    """A value per template, looked up by number."""
    return F.get(F.array(*[F.lit(value(t)) for t in templates]), F.col("template"))


def _covered(at: Column, run: Column) -> Column:
    """Number of template words that runs at `at` cover."""
    starts = F.array_sort(F.array_distinct(at))
    steps = F.transform(starts, lambda p, i: F.least(run, F.coalesce(F.get(starts, i + 1) - p, run)))
    return F.aggregate(steps, F.lit(0), lambda a, x: (a + x).cast("int"))


def template_spans(hits: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """row_id, template, first and end (words, end exclusive) and coverage of every accepted span."""
    run, length = _facts(templates, lambda t: t.run), _facts(templates, lambda t: len(t.words))
    least, shift = _facts(templates, lambda t: float(t.least)), _facts(templates, lambda t: t.shift)
    # a diagonal meets each position of the template once at most, which bounds the array
    votes = hits.filter("template >= 0").groupBy("row_id", "template", "diagonal").agg(F.collect_set("at").alias("at"))
    along = Window.partitionBy("row_id", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(along)
    opens = F.coalesce(gap > F.greatest(shift, F.lit(0)), F.lit(True)).cast("int")
    grouped = votes.withColumn("opens", opens).withColumn("cluster", F.sum("opens").over(along))
    lone = F.struct(
        (_covered(F.col("at"), run) / length).alias("coverage"),
        (F.col("diagonal") + F.array_min("at")).alias("first"),
        (F.col("diagonal") + F.array_max("at") + run).alias("end"),
    )
    merged = (
        grouped.withColumn("lone", lone)
        .groupBy("row_id", "template", "cluster")
        .agg(
            F.max("lone").alias("lone"),
            F.array_distinct(F.flatten(F.collect_set("at"))).alias("at"),  # fewer than the text's hits
            F.min("lone.first").alias("first"),
            F.max("lone.end").alias("end"),
        )
    )
    whole = F.struct((_covered(F.col("at"), run) / length).alias("coverage"), "first", "end")
    fits = (F.col("end") - F.col("first")) <= F.ceil(length * (1 + STRETCH))
    best = F.when(fits & (whole["coverage"] >= F.col("lone.coverage")), whole).otherwise(F.col("lone"))
    judged = merged.select("row_id", "template", best.alias("span")).select("row_id", "template", "span.*")
    return judged.filter(F.col("coverage") >= least)


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans.

    spans has (first, end, label, coverage) of every accepted span by place; score is the largest coverage.
    """
    templates = templates or (Template("", ""),)  # one that has no runs
    hits = template_hits(docs, templates)
    spans = template_spans(hits, templates)
    label, base = _facts(templates, lambda t: t.label), _facts(templates, lambda t: t.base)
    span = F.struct("first", "end", label.alias("label"), "coverage", base.alias("base"))
    marks = hits.filter("template < 0").select("row_id", "doc_id", "n_words", F.lit(None).alias("span"))
    rows = marks.unionByName(
        spans.select("row_id", span.alias("span")), allowMissingColumns=True
    )
    # a text's spans are fewer than its words times the templates
    whole = rows.groupBy("row_id").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.array_sort(F.collect_list("span")).alias("spans")
    )
    of_base = F.filter("spans", lambda s: s["base"])

    def labels(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda s: s["label"]))), ",")

    starts = F.transform(of_base, lambda s: s["first"].cast("long"))
    return whole.select(
        "doc_id",
        "n_words",
        F.size(of_base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(of_base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"),
        F.transform("spans", lambda s: F.struct(s["first"], s["end"], s["label"], s["coverage"])).alias("spans"),
    )
