"""Idempotent order intake, read-back and reproducible demo orders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.functions import identity
from stockweave.operators.carts import price_carts, validate_carts
from stockweave.operators.ranking import number_within, rank_rows
from stockweave.session import settle_table

CONFLICT = "This checkout key already belongs to a different cart. Start a new checkout."
CREATED, REPLAYED, CONFLICTED, REFUSED = "created", "replayed", "conflict", "refused"


def order_id_of(key) -> Column:
    """Fixed by the key, so a repeated task or batch writes the same id."""
    return F.concat(F.lit("ord-"), identity.uuid_form(F.substring(F.sha2(key, 256), 1, 32)))


@dataclass(frozen=True)
class Commit:
    """`outcomes` answers every submission; the other two are the rows to append."""

    outcomes: DataFrame
    orders: DataFrame
    items: DataFrame


def key_bucket(key="idempotency_key") -> Column:
    """One of 256 parts of the order store, by the hash of the key."""
    return F.substring(F.sha2(F.lower(F.col(key)), 256), 1, 2)


def _stored_answers(orders: DataFrame, keys: DataFrame) -> DataFrame:
    """Orders that exist for the keys of this batch; they answer every submission.

    Where orders are stored by `bucket`, only the buckets of these keys (256 at most) are read.
    """
    if "bucket" in orders.columns:
        buckets = [r[0] for r in keys.select(key_bucket("key")).distinct().collect()]
        orders = orders.filter(F.col("bucket").isin(buckets))
    return (
        orders.select(
            F.col("idempotency_key").alias("key"),
            F.col("id").alias("order_id"),
            F.col("request_hash").alias("known_hash"),
            F.col("total_minor").alias("known_total"),
        )
        .join(keys, "key", "left_semi")
        .withColumn("winner_seq", F.lit(None).cast("bigint"))
    )


def _new_answers(priced: DataFrame) -> DataFrame:
    """First priceable submission per key: earlier failures do not use the key up.

    A minimum per key, combined map-side, whatever number of retries a key has.
    """
    winner = F.min(F.struct("submission_seq", "fingerprint", "total_minor")).alias("w")
    good = priced.filter(F.col("price_error_code").isNull()).groupBy("key").agg(winner)
    return good.select(
        "key",
        order_id_of("key").alias("order_id"),
        F.col("w.fingerprint").alias("known_hash"),
        F.col("w.total_minor").cast("bigint").alias("known_total"),
        F.col("w.submission_seq").alias("winner_seq"),
    )


def commit_orders(
    submissions: DataFrame, orders: DataFrame, products: DataFrame, created_at, scratch: str | None = None
) -> Commit:
    """Exactly one order per key.

    A key that is stored already answers by its hash alone, before any product
    is looked at; only carts with a new key are priced. `orders` are the stored
    headers, `products` the orderable ones, `created_at` the time of the batch.
    The checked and the priced carts and the new answers are written once each, since several
    steps read them; with `scratch` to that folder, over those of the batch before.
    """
    # a source that delivers at least once may repeat a submission; it counts once, valid or not. Before
    # the check all columns are plain, so the copies meet in a hash aggregate without a sort.
    once = submissions.select("submission_seq", "idempotency_key", "body").distinct()
    checked = settle_table(validate_carts(once).drop("body", "idempotency_key"), "carts", scratch)
    valid = checked.filter(F.col("error_code").isNull())
    stored = settle_table(_stored_answers(orders, valid.select("key").distinct()), "stored", scratch)
    fresh = valid.join(stored.select("key"), "key", "left_anti")
    priced = settle_table(price_carts(fresh, products, unique=True), "priced", scratch)
    new = settle_table(_new_answers(priced), "answers", scratch)
    # a key is either stored or new: one table of answers, one join on the key
    answers = stored.unionByName(new)
    failures = priced.filter(F.col("price_error_code").isNotNull()).select(
        "submission_seq", "price_error_code", "price_error_message"
    )
    asked = valid.select("submission_seq", "key", "fingerprint")
    answered = asked.join(answers, "key", "left").join(failures, "submission_seq", "left")
    same = F.col("known_hash") == F.col("fingerprint")
    # submissions that came before the winner of their key were refused
    settled = F.col("known_hash").isNotNull() & F.coalesce(
        F.col("submission_seq") >= F.col("winner_seq"), F.lit(True)
    )
    outcome = (
        F.when(F.col("submission_seq") == F.col("winner_seq"), F.lit(CREATED))
        .when(settled & same, F.lit(REPLAYED))
        .when(settled, F.lit(CONFLICTED))
        .otherwise(F.lit(REFUSED))
    )
    answered = answered.withColumn("outcome", outcome)
    has_order = F.col("outcome").isin(CREATED, REPLAYED)
    conflict = F.col("outcome") == CONFLICTED
    refused = F.col("outcome") == REFUSED
    outcomes = answered.select(
        "submission_seq",
        "key",
        "outcome",
        F.when(has_order, F.col("order_id")).alias("order_id"),
        F.when(has_order, F.col("known_total")).alias("total_minor"),
        F.when(conflict, F.lit("idempotency_conflict")).when(refused, F.col("price_error_code")).alias("error_code"),
        F.when(conflict, F.lit(CONFLICT)).when(refused, F.col("price_error_message")).alias("error_message"),
    )
    invalid = checked.filter(F.col("error_code").isNotNull()).select(
        "submission_seq",
        "key",
        F.lit(REFUSED).alias("outcome"),
        F.lit(None).cast("string").alias("order_id"),
        F.lit(None).cast("bigint").alias("total_minor"),
        "error_code",
        "error_message",
    )
    winners = new.select(F.col("winner_seq").alias("submission_seq"))
    created = priced.join(winners, "submission_seq", "left_semi").withColumn("order_id", order_id_of("key"))
    headers = created.select(
        F.col("order_id").alias("id"),
        F.col("key").alias("idempotency_key"),
        F.col("fingerprint").alias("request_hash"),
        F.lit("visitor").alias("source"),
        F.col("total_minor").cast("bigint").alias("total_minor"),
        F.lit(created_at).cast("timestamp").alias("created_at"),
    )
    lines = created.select("order_id", F.inline("priced"))
    return Commit(outcomes.unionByName(invalid), headers, lines)


def read_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their lines: one row per line, header columns repeated.

    The lines of an order stand together and in order; orders have no order among
    themselves, so nothing is sorted beyond the partitions of the join.
    """
    headers = orders.select(
        F.col("id").alias("order_id"), "total_minor", "source", "created_at", F.lit("INR").alias("currency")
    )
    return headers.join(items, "order_id").repartition("order_id").sortWithinPartitions("order_id", "line_no")


def read_order(orders: DataFrame, items: DataFrame, order_id) -> DataFrame:
    wanted = F.lit(order_id)
    return read_orders(orders.filter(F.col("id") == wanted), items.filter(F.col("order_id") == wanted))


def number_lines(items: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Line numbers per order, by product, size and color unless another order is given."""
    order = order or [F.col(c) for c in ("product_id", "size", "color")]
    return number_within(items, ["order_id"], order)


# orders of one month are generated in runs of this many, spread over the tasks
RUN_LENGTH = 1000


def synth_orders(products: DataFrame, months: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reproducible demo orders: headers and lines, no random state.

    `months` has year, month and orders. Number n of a month gets 1 + n % 3
    lines; each picks the product at rank (7 month + 3 n + 5 offset) mod N of
    the catalog sorted by id, quantity 1 + (month + n + offset) % 3.
    """
    runs = months.filter("orders > 0").select(
        "year",
        "month",
        "orders",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("orders") - 1) / RUN_LENGTH))).alias("_run"),
    )
    # a month of any size becomes many short runs before it is unfolded. Runs are few bytes and many orders,
    # so their number of parts is given: by size alone AQE would put all of them into one task
    parts = int(products.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = runs.repartition(parts, "year", "month", "_run")
    first = F.col("_run") * RUN_LENGTH + 1
    last = F.least(first + RUN_LENGTH - 1, F.col("orders"))
    numbers = runs.select("year", "month", F.explode(F.sequence(first, last)).alias("number"))
    number_text = F.format_string("%03d", "number")
    stamp = F.format_string("%04d%02d", "year", "month")
    lines = numbers.select(
        "year",
        "month",
        "number",
        F.concat(F.lit("demo-"), stamp, F.lit("-"), number_text).alias("order_id"),
        F.explode(F.sequence(F.lit(0), (F.col("number") % 3).cast("int"))).alias("offset"),
    )
    size = products.agg(F.count("*")).scalar()
    pick = (F.col("month") * 7 + F.col("number") * 3 + F.col("offset") * 5) % size
    lines = lines.withColumn("_rank", pick + 1).withColumn(
        "quantity", (1 + (F.col("month") + F.col("number") + F.col("offset")) % 3).cast("int")
    )
    ranked = rank_rows(products, [F.col("id").asc()], "_rank")
    # the runs' size says nothing of the lines unfolded from them, so the planner must not broadcast these
    picked = lines.join(ranked.hint("merge"), "_rank")
    snapshot = F.struct(
        *[
            (F.col(c).cast("int") if c == "featured" else F.col(c)).alias(c)
            for c in sorted(("alt", "category", "colors", "description", "featured", "id", "image", "name",
                             "price_minor", "sizes"))
        ]
    )
    # at most three lines per order
    entries = F.array_sort(
        F.collect_list(F.struct("offset", F.struct(snapshot.alias("product"), "quantity").alias("item")))
    )
    grouped = picked.groupBy("order_id", "year", "month", "number").agg(
        F.sum(F.col("price_minor") * F.col("quantity")).cast("bigint").alias("total_minor"),
        entries.alias("entries"),
    )
    content = F.to_json(F.transform("entries", lambda e: e["item"]))
    day = F.least(F.col("number") * 3, F.lit(24))
    headers = grouped.select(
        F.col("order_id").alias("id"),
        F.concat(F.lit("seed-"), "order_id").alias("idempotency_key"),
        F.sha2(identity.ascii_json(content), 256).alias("request_hash"),
        F.lit("synthetic").alias("source"),
        "total_minor",
        F.format_string("%04d-%02d-%02dT12:00:00Z", "year", "month", day).alias("created_at"),
    )
    items = picked.select(
        "order_id",
        (F.col("offset") + 1).cast("int").alias("line_no"),
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        "category",
        F.col("price_minor").alias("unit_price_minor"),
        "quantity",
        F.try_element_at("sizes", F.lit(1)).alias("size"),
        F.try_element_at("colors", F.lit(1)).alias("color"),
    )
    return headers, items
