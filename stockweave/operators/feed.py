"""Feed import: duplicates inside the feed and against existing rows, statuses, reports."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.functions import text, urls
from stockweave.operators.feed_rules import Item, key_feed, key_of, product_columns, validate_feed
from stockweave.schemas import LEDGER
from stockweave.session import settle, settle_table

# Rules in the order in which they are asked, with the reasons they give.
URL, IDENTITY, PRODUCT, OWN_ID = 1, 2, 3, 4
# Duplicate reasons and actions.
DUPLICATE_REASONS = {
    URL: "same normalized canonical source URL",
    IDENTITY: "same retailer and retailer product ID",
    PRODUCT: "same normalized title, brand, category, variants and image",
}
ACTIONS = {
    "EXISTING": "kept existing validated product; incoming row did not overwrite it",
    "DUPLICATE": "not inserted; existing product retained",
    "REJECTED": "not inserted; excluded from active catalog",
    "ACCEPTED": "inserted into active import set",
}
NOT_AN_OBJECT = "not inserted; input must be a product object"


def _pair(store: Column, source_id: Column) -> Column:
    return F.when((store != "") & (source_id != ""), F.concat_ws("\u0001", text.fold(store), text.fold(source_id)))


def _variant_keys(labels: Column) -> Column:
    return F.array_sort(F.filter(F.transform(labels, text.text_key), lambda x: x != ""))


def _product_key(name: Column, brand: Column, category: Column, variants: Column, image: Column) -> Column:
    parts = [name, brand, category, F.size(variants).cast("string"), F.concat_ws("\u0002", variants), image]
    return F.when((name != "") & (brand != ""), F.concat_ws("\u0001", *parts))


def _keys(**by_rule: Column) -> Column:
    """Array of (rule, key); a rule that does not apply has a NULL key."""
    rules = {"url": URL, "identity": IDENTITY, "product": PRODUCT, "own_id": OWN_ID}
    entries = [F.struct(F.lit(rules[n]).alias("rule"), k.alias("key")) for n, k in by_rule.items()]
    return F.array(*entries)


def _blank_key(key: Column) -> Column:
    """The key of a missing URL is no key."""
    return text.let(key, lambda k: F.when(k != "/", k))


def with_keys(validated: DataFrame) -> DataFrame:
    """Keys a row asks for and keys it registers once it is known to be live."""
    item = Item()
    color = F.when(
        item.truthy("color"), F.array(text.text_key(item.text("color")))
    ).otherwise(F.array().cast("array<string>"))
    image = F.element_at(F.concat(item.strings("image_urls"), F.array(F.lit(""))), 1)
    # each part is computed once; the keys below name them several times
    parts = {
        "_name": text.text_key(item.text_or_blank("title")),
        "_brand": text.text_key(item.text_or_blank("brand")),
        "_group": text.blank_if_null("category"),
        "_variants": F.concat(_variant_keys(item.strings("sizes")), color),
        "_image": urls.url_key(image),
        "_canonical": F.when(item.truthy("canonical_url"), _blank_key(key_of(item.text("canonical_url")))),
    }
    validated = validated.withColumns(parts)
    product = _product_key(*[F.col(n) for n in ("_name", "_brand", "_group", "_variants", "_image")])
    validated = validated.withColumn("_product", product)
    asked = _keys(
        url=F.col("_canonical"),
        identity=_pair(item.text_or_blank("source_store"), item.text_or_blank("source_product_id")),
        product=F.col("_product"),
        own_id=F.col("product_id"),
    )
    registered = _keys(
        url=F.nullif(F.col("source_key"), F.lit("/")),
        identity=_pair(F.col("store"), F.col("source_id")),
        product=F.when((F.col("_group") != "") & (F.col("image_url") != ""), F.col("_product")),
    )
    usable = F.col("is_object") & F.col("product_id").isNotNull()
    none = F.array().cast("array<struct<rule:int,key:string>>")
    return validated.withColumn("asked", F.when(F.col("is_object"), asked).otherwise(none)).withColumn(
        "registered", F.when(usable, registered).otherwise(none)
    )


def match_base(catalog: DataFrame, ledger: DataFrame) -> DataFrame:
    """Existing rows in the order they are asked: catalog by id, then ledger by id."""
    first = catalog.withColumn("origin", F.lit(0))
    return first.unionByName(ledger.withColumn("origin", F.lit(1)), allowMissingColumns=True)


def existing_keys(base: DataFrame) -> DataFrame:
    """origin, id and keys, an array of (rule, key), of every existing row with an id."""
    has = set(base.columns)
    column = lambda n: text.blank_if_null(n) if n in has else F.lit("")
    none = F.array().cast("array<string>")
    labels = lambda n: F.coalesce(F.col(n), none) if n in has else none
    variants = F.concat(_variant_keys(labels("sizes")), _variant_keys(labels("colors")))
    product = _product_key(
        text.text_key(column("name")),
        text.text_key(column("brand")),
        text.fold(column("category")),
        variants,
        urls.url_key(column("image")),
    )
    keys = _keys(
        url=_blank_key(urls.url_key(column("canonical_url"))),
        identity=_pair(column("source_store"), column("source_product_id")),
        product=product,
        own_id=F.col("id"),
    )
    known = F.filter(keys, lambda k: k["key"].isNotNull()).alias("keys")
    return base.filter(F.col("id").isNotNull()).select("origin", "id", known)


def first_owners(entries: DataFrame) -> DataFrame:
    """The first (origin, id) of every (rule, key)."""
    return entries.groupBy("rule", "key").agg(F.min(F.struct("origin", "id")).alias("first"))


def base_keys(base: DataFrame) -> DataFrame:
    """First existing row (origin, id) for every key, one row per (rule, key)."""
    return first_owners(existing_keys(base).select("origin", "id", F.inline("keys")))


def match_existing(asked: DataFrame, keys: DataFrame) -> DataFrame:
    """Per feed row: the first existing row any rule finds, and whether its own id exists.

    Three equality lookups, each key at most once on the existing side, in place
    of an OR join of every pair.
    """
    found = asked.join(keys, ["rule", "key"])
    matched = F.when(F.col("rule") < OWN_ID, F.struct(F.col("first"), F.col("rule")))
    return found.groupBy("pos").agg(
        F.min(matched).alias("match"), F.bool_or(F.col("rule") == OWN_ID).alias("own_id_exists")
    )


def live_rows(rows: DataFrame, asked: DataFrame, registered: DataFrame) -> DataFrame:
    """Positions of rows that register their keys.

    A row is live when it is valid, matches an existing row, or shares a key with
    an earlier live row. The keys of the first two kinds, the seeds, are reduced to a
    minimum per key once. Afterwards only the other rows and their keys are looked
    at: each round writes the positions that became live, and the rounds end after the
    longest chain of otherwise invalid rows. `rows` has pos, seed, and is stored.
    """
    live, late = rows.filter("seed").select("pos"), rows.filter("not seed").select("pos")
    waiting = settle(asked.filter(F.col("rule") < OWN_ID).join(late, "pos", "left_semi"))
    if waiting.isEmpty():
        return live
    first, own, reached_so_far = _first_positions(registered, live), None, late.limit(0)
    while True:
        reached = waiting.join(first, ["rule", "key"]).filter("first_pos < pos").select("pos").distinct()
        fresh = settle(reached.join(reached_so_far, "pos", "left_anti"))
        if fresh.isEmpty():
            return live
        live, reached_so_far = live.unionByName(fresh), reached_so_far.unionByName(fresh)
        own = settle(registered.join(late, "pos", "left_semi").select("pos", "rule", "key")) if own is None else own
        first = _first_positions(own, fresh)


def _first_positions(registered: DataFrame, live: DataFrame) -> DataFrame:
    """Per key the first live row that registers it."""
    return registered.join(live, "pos", "left_semi").groupBy("rule", "key").agg(F.min("pos").alias("first_pos"))


@dataclass(frozen=True)
class FeedImport:
    """`rows` has one classified row per feed item."""

    rows: DataFrame

    @property
    def results(self) -> DataFrame:
        """The per-item report."""
        flags = F.col("validation").withField("not_duplicate", F.col("duplicate_of").isNull())
        return self.rows.select(
            "pos",
            "product_id",
            F.when(F.col("title") != "", F.col("title")).alias("title"),
            "source_url",
            "status",
            flags.alias("validation"),
            "duplicate_of",
            "duplicate_reason",
            F.try_element_at("failure_reasons", F.lit(1)).alias("failure_reason"),
            "failure_reasons",
            "action_taken",
        )

    @property
    def accepted(self) -> DataFrame:
        good = self.rows.filter(F.col("status") == "ACCEPTED")
        return good.select("pos", *[F.col("product")[f].alias(f) for f in LEDGER.fieldNames()])


def dedupe_feed(rows: DataFrame, base: DataFrame) -> DataFrame:
    """`dedupe_feed_with` against existing rows."""
    return dedupe_feed_with(rows, lambda asked: base_keys(base))


def dedupe_feed_with(rows: DataFrame, owners_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Per position: first owner inside the feed, first existing match, own id known.

    `rows` has pos, product_id, reasons and the key arrays. Owners come from a
    minimum per key instead of a window over the copies of a key, so a key that a
    third of the feed shares is combined map-side. `owners_of` gives the first existing
    owners of the keys (rule, key) that it is asked for.
    """
    asked = rows.select("pos", F.inline("asked")).filter(F.col("key").isNotNull())
    registered = rows.select("pos", "product_id", F.inline("registered")).filter(F.col("key").isNotNull())
    valid = rows.select("pos", (F.size("reasons") == 0).alias("_valid"))
    known = valid.join(match_existing(asked, owners_of(asked)), "pos", "left")
    # matches and seeds in one table: the rounds and the last join read it
    seeds = settle(known.select("pos", "match", "own_id_exists", (F.col("_valid") | F.col("match").isNotNull()).alias("seed")))
    live = live_rows(seeds, asked, registered)
    owners = (
        registered.join(live, "pos", "left_semi")
        .groupBy("rule", "key")
        .agg(F.min(F.struct("pos", "product_id")).alias("owner"))
    )
    inside = asked.join(owners, ["rule", "key"]).filter(F.col("owner.pos") < F.col("pos"))
    in_feed = inside.groupBy("pos").agg(F.min(F.struct("rule", "owner")).alias("in_feed"))
    return seeds.select("pos", "match", "own_id_exists").join(in_feed, "pos", "left")


def classify_feed(feed: DataFrame, pages: DataFrame, images: DataFrame, base: DataFrame) -> FeedImport:
    """`classify_feed_with` against existing rows, see `match_base`."""
    return classify_feed_with(feed, pages, images, lambda asked: base_keys(base))


def classify_feed_with(
    feed: DataFrame, pages: DataFrame, images: DataFrame, owners_of: Callable[[DataFrame], DataFrame]
) -> FeedImport:
    """Validate, de-duplicate and give every item its status; `owners_of` as in `dedupe_feed_with`.

    The validated rows are written once: the key rounds then read three columns
    of them, and the last join the rest.
    """
    validated = with_keys(validate_feed(key_feed(feed), pages, images))
    product = F.struct(*[c.cast(LEDGER[f].dataType).alias(f) for f, c in product_columns().items()])
    rows = settle_table(
        validated.select(
            "pos", "is_object", "product_id", "title", "source_url", "reasons", "validation", "asked", "registered",
            F.when(F.size("reasons") == 0, product).alias("product"),
        ),
        "feed",
    )
    found = dedupe_feed_with(rows, owners_of)
    joined = rows.drop("asked", "registered").join(found, "pos", "left")
    # an owner inside the feed is asked before the existing rows
    owner = F.coalesce(F.col("in_feed.owner.product_id"), F.col("match.first.id"))
    rule = F.coalesce(F.col("in_feed.rule"), F.col("match.rule"))
    reason = F.lit(None).cast("string")
    for number, words in DUPLICATE_REASONS.items():
        reason = F.when(rule == number, F.lit(words)).otherwise(reason)
    joined = joined.withColumn("duplicate_of", owner).withColumn("duplicate_reason", reason)
    own = (F.col("duplicate_of") == F.col("product_id")) & F.coalesce("own_id_exists", F.lit(False))
    status = (
        F.when(F.col("duplicate_of").isNotNull(), F.when(own, F.lit("EXISTING")).otherwise(F.lit("DUPLICATE")))
        .when(F.size("reasons") > 0, F.lit("REJECTED"))
        .otherwise(F.lit("ACCEPTED"))
    )
    joined = joined.withColumn("status", status)
    reasons = F.when(
        F.col("status") == "DUPLICATE", F.array_distinct(F.concat("reasons", F.array(F.lit("DUPLICATE_PRODUCT"))))
    ).otherwise(F.col("reasons"))
    action = F.lit(NOT_AN_OBJECT)
    for name, words in ACTIONS.items():
        action = F.when(F.col("is_object") & (F.col("status") == name), F.lit(words)).otherwise(action)
    return FeedImport(joined.withColumn("failure_reasons", reasons).withColumn("action_taken", action))


def import_summary(results: DataFrame) -> DataFrame:
    count = lambda s: F.count_if(F.col("status") == s)
    return results.agg(
        F.count("*").alias("urls_received"),
        count("ACCEPTED").alias("successfully_added"),
        (count("ACCEPTED") + count("EXISTING")).alias("valid_imports"),
        count("EXISTING").alias("already_existed"),
        count("DUPLICATE").alias("duplicates"),
        count("REJECTED").alias("rejected"),
    )


def failure_breakdown(results: DataFrame) -> DataFrame:
    """Occurrences per reason over rejected and duplicate rows."""
    failed = results.filter(F.col("status").isin("REJECTED", "DUPLICATE"))
    return failed.select(F.explode("failure_reasons").alias("reason")).groupBy("reason").agg(
        F.count("*").alias("occurrences")
    )
