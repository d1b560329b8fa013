"""URL filters by a Bloom filter cascade.

A cascade answers "is this key listed?" without error for every key of a fixed
universe. Level 1 holds the listed keys; the keys of the universe that pass it
though they are not listed go into level 2; the listed keys that pass level 2 go
into level 3, and so on until a level lets nothing wrong through. A key is looked
up by walking the levels until one rejects it: rejected at an odd level means not
listed, at an even level listed.

Keys are built from URLs: the last n labels of the host followed by the first m
characters of the path, for the label counts n and path lengths m that occur in
the lists. Building needs the distinct keys of the corpus once; judging the URLs
then needs no join and no shuffle.

A level is built where the keys are: every task sets bits of its own keys, bits
are joined word by word in an aggregate, and only the finished filter, of bounded
size, reaches the driver and the tasks. Lists too long for one filter of
`MAX_KEYS` keys are cut into shards by key hash, each with its own cascade, which
are applied one after the other.

Null URLs and URLs without `://` have empty host and path, match nothing and get
the verdict `allow`. Repeated rows stay repeated; an empty table gives no rows;
other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.session import settle_table

# most listed keys in one cascade; level 1 then takes at most MAX_KEYS * BITS_PER_KEY bits (5 MB)
MAX_KEYS = 4_000_000
BITS_PER_KEY = 10
PROBES = 5
# words of the smallest level: short lists then need few levels
LEAST_WORDS = 256
# a cascade of independent levels ends after a handful; this many means equal hashes
MAX_LEVELS = 40
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class Rule:
    """`verdict` for `host` and its subdomains where the path starts with `path`."""

    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end; empty without `://`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _keys(label_counts: Iterable[int], path_lengths: Iterable[int]) -> Column:
    """Every key of a row (`host`, `path`) that a list could hold, longest first."""
    labels = F.split("host", r"\.")
    keys = []
    for n in label_counts:
        suffix = F.array_join(F.slice(labels, F.lit(-n), F.lit(n)), ".")
        for m in path_lengths:
            fits = (F.size(labels) >= n) & (F.length("path") >= m) & (F.col("host") != "")
            keys.append(F.when(fits, F.concat(suffix, F.substring("path", 1, m))))
    by_length = F.array_sort(
        F.transform(F.array_compact(F.array(*keys)), lambda k: F.struct((-F.length(k)).alias("n"), k.alias("k")))
    )
    return F.transform(by_length, lambda s: s["k"])


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")]


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x ^ np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Bit numbers of each key at a level, one row per probe."""
    a, b = _mix(h1.view(np.uint64), 2 * level + 1), _mix(h2.view(np.uint64), 2 * level + 2) | np.uint64(1)
    return np.stack([(a + np.uint64(i) * b) % np.uint64(bits) for i in range(PROBES)])


def _passes(h1: np.ndarray, h2: np.ndarray, level: int, words: np.ndarray) -> np.ndarray:
    at = _positions(h1, h2, level, 64 * len(words))
    return ((words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


def _listed(h1: np.ndarray, h2: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Walk the levels; right for every key of the universe the cascade was built for."""
    found = np.zeros(len(h1), dtype=bool)
    alive = np.arange(len(h1))
    for level, words in enumerate(levels):
        if not len(alive):
            break
        alive = alive[_passes(h1[alive], h2[alive], level, words)]
        found[alive] = level % 2 == 0
    return found


def _build_level(keys: DataFrame, level: int, count: int) -> np.ndarray:
    """The filter that holds `keys` (h1, h2)."""
    size = max(LEAST_WORDS, -(-count * BITS_PER_KEY // 64))

    def own_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            at = np.unique(_positions(rows["h1"].to_numpy(), rows["h2"].to_numpy(), level, 64 * size))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            bit = np.uint64(1) << (at & np.uint64(63))
            bits = np.bitwise_or.reduceat(bit, first) if len(bit) else bit
            yield pd.DataFrame({"word": word.astype(np.int64), "bits": bits.view(np.int64)})

    words = keys.mapInPandas(own_words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    got = words.toPandas()
    out = np.zeros(size, dtype=np.uint64)
    out[got["word"].to_numpy(dtype=np.int64)] = got["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def build_cascade(universe: DataFrame) -> list[np.ndarray]:
    """The levels for `universe` (h1, h2, listed boolean), which holds each key once."""
    count = universe.filter("listed").count()
    levels: list[np.ndarray] = []
    inside = universe.filter("listed")
    while count and len(levels) < MAX_LEVELS:
        level = len(levels)
        levels.append(_build_level(inside, level, count))

        def wrong(batches, levels=tuple(levels), level=level):
            # keys of the other kind that came through every level so far
            for rows in batches:
                rows = rows[rows["listed"] == (level % 2 == 1)]
                h1, h2 = rows["h1"].to_numpy(), rows["h2"].to_numpy()
                alive = np.arange(len(h1))
                for n, words in enumerate(levels):
                    alive = alive[_passes(h1[alive], h2[alive], n, words)]
                yield rows.iloc[alive]

        inside = settle_table(universe.mapInPandas(wrong, universe.schema), "url-level")
        count = inside.count()
    if count:
        raise ValueError("two keys of the universe have equal hashes")
    return levels


def _cascades(keys: DataFrame, listed: DataFrame, max_keys: int) -> list[list[np.ndarray]]:
    """One cascade per shard for the distinct `keys` (key) and the `listed` ones (key)."""
    marked = keys.join(listed.select("key", F.lit(True).alias("_in")).distinct(), "key", "left")
    universe = settle_table(
        marked.select(*_hashes(F.col("key")), F.col("_in").isNotNull().alias("listed")), "url-universe"
    )
    shards = max(1, -(-universe.filter("listed").count() // max_keys))
    return [build_cascade(universe.filter(F.pmod("h1", F.lit(shards)) == s)) for s in range(shards)]


def _probe(rows: DataFrame, shard: int, shards: int, levels: dict[str, list[np.ndarray]]) -> DataFrame:
    """Add to the array of hits the numbers of the keys that each named cascade lists."""

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["h1"].str.len().to_numpy(dtype=np.int64)
            flat = [np.concatenate([np.asarray(x, np.int64) for x in batch[h]] or [[]]).astype(np.int64) for h in ("h1", "h2")]
            ends = np.cumsum(sizes)[:-1]
            own = (flat[0] % shards) == shard  # numpy's remainder has the sign of the divisor, like pmod
            for name, cascade in levels.items():
                hit = _listed(*flat, cascade) & own
                old = batch[name]
                batch[name] = [np.union1d(o, np.flatnonzero(h)).astype(np.int32) for o, h in zip(old, np.split(hit, ends))]
            yield batch

    return rows.mapInPandas(look_up, rows.schema)


def _tagged(verdict: str) -> Column:
    return F.transform(verdict, lambda i: F.struct(i.alias("at"), F.lit(verdict[1:]).alias("verdict")))


def filter_urls(
    pages: DataFrame, rules: Iterable[Rule], blocked_hosts: DataFrame, max_keys: int = MAX_KEYS
) -> DataFrame:
    """Judge `pages` (page_id, url): page_id, host, path, rule, verdict.

    `blocked_hosts` (host): hosts that are blocked with all their subdomains
    where no rule fits. `rule` is the longest fitting rule, else null.
    """
    rules = sorted(set(rules), key=lambda r: r.key)
    spark = pages.sparkSession
    blocked = settle_table(
        blocked_hosts.filter(F.col("host") != "").select(F.col("host").alias("key")).distinct(), "url-listed"
    )
    counts = blocked.select(F.size(F.split("key", r"\.")).alias("n")).distinct().collect()
    label_counts = sorted({r.host.count(".") + 1 for r in rules} | {row["n"] for row in counts})
    path_lengths = sorted({0} | {len(r.path) for r in rules})
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not label_counts:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    keyed = rows.withColumn("keys", _keys(label_counts, path_lengths))
    universe = settle_table(keyed.select(F.explode("keys").alias("key")).distinct(), "url-keys")

    lists = {"_listed": blocked}
    for verdict in sorted({r.verdict for r in rules}):
        named = [(r.key,) for r in rules if r.verdict == verdict]
        lists[f"_{verdict}"] = spark.createDataFrame(named, "key string")
    built = {name: _cascades(universe, listed, max_keys) for name, listed in lists.items()}

    probed = keyed.withColumns(
        {
            "h1": F.transform("keys", lambda k: F.xxhash64(k)),
            "h2": F.transform("keys", lambda k: F.xxhash64(F.lit("second"), k)),
            **{name: F.lit(None).cast("array<int>") for name in lists},
        }
    ).withColumns({name: F.array().cast("array<int>") for name in lists})
    steps = [
        (shard, len(shards), {name: shards[shard]})
        for name, shards in built.items()
        for shard in range(len(shards))
        if len(shards) > 1
    ]
    single = {name: shards[0] for name, shards in built.items() if len(shards) == 1}
    probed = _probe(probed, 0, 1, single)
    for shard, shards, levels in steps:  # one filter in memory at a time
        probed = settle_table(_probe(probed, shard, shards, levels), "url-shard")

    verdicts = [name for name in lists if name != "_listed"]
    # keys are longest first, so the first hit of any rule is the rule that wins
    hits = [_tagged(v) for v in verdicts]
    best = F.array_min(F.flatten(F.array(*hits))) if hits else F.lit(None).cast("struct<at:int,verdict:string>")
    method = F.when(F.size("_listed") > 0, "block").otherwise("allow")
    return probed.withColumn("_best", best).select(
        "page_id",
        "host",
        "path",
        F.when(F.col("_best").isNotNull(), F.get("keys", F.col("_best.at"))).alias("rule"),
        F.coalesce(F.col("_best.verdict"), method).alias("verdict"),
    )
