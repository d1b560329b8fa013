"""Secret scans by a trigram inverted index; DataFrame functions only.

Each rule is a regular expression. `trigram_query` turns its expression into a
Boolean query: a conjunction of clauses, each a choice of trigram sets of which a
matching text holds one whole. The index has a posting (trigram, document) for every
trigram that some rule asks for. A document's postings meet in one aggregate, the
queries run on them, and only documents that satisfy a rule's query are scanned for
that rule. Rules whose expression forces no trigram (a run of hex digits) scan all
documents. Trigrams are taken from the lower-cased text, so the index never misses a
match in either case; the expression itself decides.

Positions come without a row per match: the pieces between matches and the matches
have lengths whose running sums are the ends. Running sums are built in two levels,
so a text with many matches stays linear.

A document is known by a hash of doc_id and text in the index; equal rows share
postings and a clash of hashes could only add a candidate. Null texts are empty and
have no spans. A span is the whole match, in code points, end exclusive. Matches of
a rule do not overlap; matches whose group is too short are dropped but still take up
their characters. Repeated rows each get their spans; an empty table gives no rows;
columns other than doc_id and text are not read by the scan.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import fresh, text_of
from stockweave.session import settle_table

MASK = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` whose `group` has `least` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# the patterns of the base kinds are fixed values; a quote is written once as a class
ASSIGN = Rule(
    "assign",
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    2,
    12,
)
ACCESS = Rule("access", r"AKIA[A-Z0-9]+", 0, 18)
HEX = Rule("hex", r"[0-9a-f]+", 0, 16)
BASE = (ASSIGN, ACCESS, HEX)
# the whole key: header lines, then all up to the END line or, where there is none, the lines of base64;
# possessive throughout, as a key may be long; line ends may be written as \\n
_BEGIN, _END = r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----END [A-Z ]*PRIVATE KEY-----"
_BREAK = r"(?:\x20|\t|\r|\n|\\r|\\n)"
_HEADERS = rf"(?:{_BREAK}++[A-Za-z][A-Za-z-]*+:\x20[^\r\n\\]*+)*+"
_TO_END = rf"""[A-Za-z0-9+/=\x20\t\r\n"'>,#*\\]*+{_END}"""
_LINES = rf"(?:{_BREAK}++[A-Za-z0-9+/]{{16,}}+={{0,2}}+)++(?:{_BREAK}++[A-Za-z0-9+/]{{1,15}}+={{0,2}}+(?=[\r\n\\]|\Z))?+"
KEY = Rule("private_key", f"{_BEGIN}(?:{_HEADERS}{_TO_END}|{_HEADERS}{_LINES})?+")
MORE = (
    KEY,
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + MORE

# a literal stretch may branch into so many strings before it is cut
_BRANCHES = 64
_CLASS = 6

Clause = frozenset[frozenset[str]]


def _literals(node) -> set[str] | None:
    """The strings a single item can stand for, or None where there are many."""
    kind, value = str(node[0]), node[1]
    if kind == "LITERAL":
        return {chr(value)}
    if kind == "IN":
        members: set[str] = set()
        for inner, what in value:
            if str(inner) == "LITERAL":
                members.add(chr(what))
            elif str(inner) == "RANGE" and what[1] - what[0] < _CLASS:
                members |= {chr(c) for c in range(what[0], what[1] + 1)}
            else:
                return None
        return members if len(members) <= _CLASS else None
    if kind == "SUBPATTERN":
        return _strings(value[3])
    if kind == "BRANCH":
        options = [_strings(b) for b in value[1]]
        return None if None in options else set().union(*options)
    if kind == "MAX_REPEAT" and value[1] == 1:
        inner = _strings(value[2])
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    return None


def _strings(nodes) -> set[str] | None:
    """All strings of a sequence, or None where there are too many."""
    found = {""}
    for node in nodes:
        options = _literals(node)
        if options is None or len(options) * len(found) > _BRANCHES:
            return None
        found = {a + b for a, b in product(found, options)}
    return found


def _clause(strings: set[str]) -> Clause | None:
    """One of the strings occurs; None if some string is too short to say so."""
    sets = {frozenset(s.lower()[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    if frozenset() in sets:
        return None
    return frozenset(s for s in sets if not any(other < s for other in sets))


def _clauses(nodes) -> set[Clause]:
    found: set[Clause] = set()
    run = {""}

    def close(start: set[str]) -> None:
        nonlocal run
        if (clause := _clause(run)) is not None:
            found.add(clause)
        run = start

    for node in nodes:
        kind = str(node[0])
        options = _literals(node)
        if options is not None and len(options) * len(run) <= _BRANCHES:
            run = {a + b for a, b in product(run, options)}
            continue
        close(options if options is not None else {""})
        if kind == "SUBPATTERN":
            found |= _clauses(node[1][3])
        elif kind == "MAX_REPEAT" and node[1][0] > 0:
            found |= _clauses(node[1][2])
    close({""})
    return found


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """Clauses of alternatives of trigrams that every text with a match satisfies; none: no restriction."""
    parsed = re._parser.parse(pattern)  # the standard library's own parser
    return sorted([sorted(sorted(a) for a in clause) for clause in _clauses(parsed)])


def build_index(docs: DataFrame, rules: tuple[Rule, ...], key: str) -> DataFrame:
    """Postings (trigram, `key`) of the trigrams that the rules ask for."""
    wanted = sorted({t for r in rules for clause in trigram_query(r.pattern) for option in clause for t in option})
    if not wanted:
        return docs.select(F.lit("").alias("trigram"), key).limit(0)
    present = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in wanted]))
    low = docs.select(key, F.lower(text_of()).alias("_low"))
    return settle_table(low.select(F.explode(present).alias("trigram"), key), "secret-postings")


def candidates(postings: DataFrame, rules: tuple[Rule, ...], key: str) -> DataFrame:
    """`key` and the kinds (array) of the indexed rules whose query its postings satisfy."""
    held = postings.groupBy(key).agg(F.collect_set("trigram").alias("held"))  # at most one per wanted trigram
    fits = []
    for rule in rules:
        if clauses := trigram_query(rule.pattern):
            query = F.lit(True)
            for clause in clauses:
                options = [F.size(F.array_intersect("held", F.array(*map(F.lit, o)))) == len(o) for o in clause]
                some = options[0]
                for option in options[1:]:
                    some = some | option
                query = query & some
            fits.append(F.when(query, F.lit(rule.kind)))
    if not fits:
        return held.select(key, F.array().cast("array<string>").alias("kinds")).limit(0)
    kinds = F.array_compact(F.array(*fits))
    return held.select(key, kinds.alias("kinds")).filter(F.size("kinds") > 0)


def _with_candidates(docs: DataFrame, rules: tuple[Rule, ...], name: str) -> DataFrame:
    """`docs` with the kinds to look for in column `name`."""
    key = fresh(docs, "text_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id"), F.lit("/"), F.col("text")))
    found = candidates(build_index(keyed, rules, key), rules, key).withColumnRenamed("kinds", name)
    # candidates are one short row per document at most, the side to hash; texts are neither sorted nor kept
    return keyed.join(found.hint("shuffle_hash"), key, "left").drop(key)


def _let(value: Column, use) -> Column:
    """`use` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sums(steps: Column, start: Column) -> Column:
    zero = F.struct(start.cast("int").alias("sum"), F.array().cast("array<int>").alias("sums"))

    def add(acc, x):
        total = (acc["sum"] + x).cast("int")
        return F.struct(total.alias("sum"), F.array_append(acc["sums"], total).alias("sums"))

    return F.aggregate(steps, zero, add, lambda acc: acc["sums"])


_BLOCK = 256


def running_sums(steps: Column) -> Column:
    """Running sums of an array of ints, in two levels so that long arrays take linear time."""
    last = F.floor((F.size(steps) - 1) / F.lit(_BLOCK)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda b: F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)))

    def joined(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: (a + x).cast("int")))
        before = _let(_sums(totals, F.lit(0)), lambda s: F.zip_with(s, totals, lambda a, b: (a - b).cast("int")))
        return F.flatten(F.zip_with(blocks, before, lambda b, at: _sums(b, at)))

    return _let(cut, joined)


def _rule_spans(text: Column, rule: Rule, number: int, held_only: bool = False) -> Column:
    """Array of (start, kind, end) of the rule's matches in `text`, or of their groups, which end the match."""
    # a bare character class with a least length needs no look at short runs
    simple = rule.group == 0 and re.fullmatch(r"(\w*\[[^\]]+\])\+", rule.pattern)
    pattern = rule.pattern[:-1] + "{%d,}" % (rule.least - len(rule.pattern.split("[")[0])) if simple else rule.pattern

    def spans(parts: Column) -> Column:
        lengths = F.transform(parts["found"], lambda m: F.length(m))
        steps = F.zip_with(F.slice(parts["gaps"], F.lit(1), F.size(parts["found"])), lengths, lambda g, n: F.length(g) + n)
        rows = F.transform(
            F.arrays_zip(running_sums(steps).alias("end"), lengths.alias("n"), parts["held"].alias("held")),
            lambda r: F.struct((r["end"] - (F.length(r["held"]) if held_only else r["n"])).alias("start"), F.lit(number).alias("kind"), r["end"].alias("end"), F.length(r["held"]).alias("held")),
        )
        kept = F.filter(rows, lambda r: r["held"] >= rule.least)
        return F.transform(kept, lambda r: F.struct(r["start"], r["kind"], r["end"]))

    parts = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)).alias("held"),
        F.split(text, pattern, -1).alias("gaps"),
    )
    return F.when(text.rlike(pattern), _let(parts, spans))


def _spans(rules: tuple[Rule, ...], kinds: str, held_only: bool = False) -> Column:
    """The spans of all rules in column text, sorted."""
    text, none, found = F.col("text"), F.array().cast("array<struct<start:int,kind:int,end:int>>"), []
    for number, rule in enumerate(rules):
        spans = _rule_spans(text, rule, number, held_only)
        if trigram_query(rule.pattern):
            spans = F.when(F.array_contains(kinds, rule.kind), spans)
        found.append(F.coalesce(spans, none))
    return F.array_sort(F.flatten(F.array(*found)))


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans: array of (start, kind number, end), by start, then rule order; a row per row of `docs`."""
    marked = _with_candidates(docs.select("doc_id", text_of().alias("text")), rules, "kinds")
    return marked.select("doc_id", _spans(rules, "kinds").alias("spans"))


def span_digest(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """`kind:start:end` of each span, joined by commas."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _ends_before(spans: Column) -> Column:
    """Largest end of the spans before each one, 0 for the first; in two levels, like `running_sums`."""

    def largest(ends: Column) -> Column:
        return F.aggregate(ends, F.lit(0), lambda a, x: F.greatest(a, x))

    def earlier(ends: Column, start: Column) -> Column:
        zero = F.struct(start.cast("int").alias("top"), F.array().cast("array<int>").alias("tops"))
        step = lambda a, x: F.struct(F.greatest(a["top"], x).alias("top"), F.array_append(a["tops"], a["top"]).alias("tops"))
        return F.aggregate(ends, zero, step, lambda a: a["tops"])

    last = F.floor((F.size(spans) - 1) / F.lit(_BLOCK)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda b: F.slice(F.transform(spans, lambda s: s["end"]), b * _BLOCK + 1, F.lit(_BLOCK)))
    return _let(cut, lambda blocks: _let(earlier(F.transform(blocks, largest), F.lit(0)), lambda tops: F.flatten(F.zip_with(blocks, tops, earlier))))


# a stretch of text is put together from blocks of so many characters, as finding a place takes a walk from the start
_TEXT_BLOCK = 4_096


def _stretch(blocks: Column, start: Column, end: Column) -> Column:
    """Characters start to end (exclusive) of a text cut into blocks."""

    def part(b: Column) -> Column:
        block, first = F.get(blocks, b), F.greatest(start - b * _TEXT_BLOCK, F.lit(0))
        return F.substr(block, first + 1, F.least(end - b * _TEXT_BLOCK, F.lit(_TEXT_BLOCK)) - first)

    numbers = F.sequence(F.floor(start / F.lit(_TEXT_BLOCK)).cast("int"), F.floor((end - 1) / F.lit(_TEXT_BLOCK)).cast("int"))
    return F.when(end > start, F.array_join(F.transform(numbers, part), "")).otherwise(F.lit(""))


def _cut_out(text: Column, spans: Column) -> Column:
    """`text` with MASK for every stretch of overlapping spans."""

    def joined(blocks: Column) -> Column:
        def replaced(before: Column) -> Column:
            pairs = F.arrays_zip(spans.alias("s"), before.alias("top"))
            # a span that begins inside an earlier one belongs to its mask
            fresh_ones = F.filter(pairs, lambda p: p["s"]["start"] >= p["top"])
            pieces = F.transform(fresh_ones, lambda p: F.concat(_stretch(blocks, p["top"], p["s"]["start"]), F.lit(MASK)))
            end = F.array_max(F.transform(spans, lambda s: s["end"]))
            return F.concat(F.array_join(pieces, ""), _stretch(blocks, end, F.length(text)))

        return _let(_ends_before(spans), replaced)

    return _let(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % _TEXT_BLOCK), F.lit(0)), joined)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with a mask for every stretch that the secret parts (the rules' groups) of matches cover; all columns stay.

    All rules look at the text as given, as in `scan_secrets`; overlapping parts get one mask, parts that
    touch one each. Null texts stay null. n_chars, if there is one, follows the new text.
    """
    kinds, found = fresh(docs, "kinds"), fresh(docs, "spans")
    marked = _with_candidates(docs, rules, kinds)
    marked = marked.withColumn(found, F.when(F.col("text").isNotNull(), F.filter(_spans(rules, kinds, True), lambda s: s["end"] > s["start"])))
    masked = F.when(F.size(found) > 0, _cut_out(F.col("text"), F.col(found))).otherwise(F.col("text"))
    marked = marked.withColumn("text", masked)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        marked = marked.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), length))
    return marked.select(*docs.columns)
