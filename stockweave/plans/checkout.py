"""Order intake over cart submissions written from the order table."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockweave.operators import carts as K
from stockweave.operators import orders as O
from stockweave.operators.catalog import active_catalog, orderable_products
from stockweave.operators.analytics import order_totals
from stockweave.plans import views as V
from stockweave.plans.views import with_views
from stockweave.schemas import CLEAN_PRODUCT, ORDERS, SUBMISSIONS
from stockweave.session import scratch_path, settle_table
from stockweave.sources.tables import load_spread, load_table
from stockweave.streaming import intake

BATCH_TIME = "2026-01-15 12:00:00"

# One submission per order. A ninth of them retry the key of order 0, a fifth the key
# of the order before; a seventh of the retries bring another cart. `s` is the seed of
# the cart, `b` of the key.
_SEEDS = """SELECT o_orderkey AS q, CASE WHEN o_orderkey % 9 = 0 THEN 0 WHEN o_orderkey % 5 = 4 THEN o_orderkey - 1
    ELSE o_orderkey END AS b FROM {orders}"""
_SEEDED = "SELECT q, b, CASE WHEN q % 7 = 0 THEN q ELSE b END AS s FROM ({seeds}) x"
_KEY = """concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-', substr(h, 17, 4), '-', substr(h, 21))"""
_QUANTITY = "CASE WHEN q % 31 = 0 THEN 11 ELSE 1 + (s + j) % 4 END"
_PRODUCT = "concat('part-', CAST((s * 7 + (j % 3) * 13) % n AS {text}))"


def submissions(spark, d, orders=None):
    orders = load_spread(spark, d, "orders", "o_orderkey") if orders is None else orders
    parts = load_table(spark, d, "part").agg(F.count("*")).first()[0]
    seeds = _SEEDED.format(seeds=_SEEDS.format(orders="{orders}"))
    lines = f"""transform(sequence(1, CAST(1 + s % 4 AS INT)), j -> concat('{{{{"product_id":"',
        {_PRODUCT.format(text='STRING')}, '","quantity":', {_QUANTITY}, ',"size":"M"}}}}'))"""
    return spark.sql(
        f"""SELECT q AS submission_seq, CASE WHEN q % 3 = 0 THEN upper({_KEY}) ELSE {_KEY} END AS idempotency_key,
            concat('{{{{"items":[', array_join({lines}, ','), ']', CASE WHEN q % 37 = 0 THEN ',"email":"x"' ELSE '' END,
                '}}}}') AS body
        FROM (SELECT *, md5(CAST(b AS STRING)) AS h, {parts}L AS n FROM ({seeds}) y) z""",
        orders=orders,
    )


def orderable(spark, d):
    live = orderable_products(V.products(spark, d), V.unavailable(spark, d), V.retired(spark, d))
    return live.select(
        F.concat(F.lit("part-"), F.col("id").cast("string")).alias("id"),
        "name",
        "category",
        "price_minor",
        F.from_json("sizes", "array<string>").alias("sizes"),
        F.array().cast("array<string>").alias("colors"),
    )


def _commit(spark, d):
    stored = spark.createDataFrame([], ORDERS)
    return O.commit_orders(submissions(spark, d), stored, orderable(spark, d), BATCH_TIME)


def commit_against_stored(spark, d):
    """Even submissions are stored already; then all come, every fifth twice."""
    carts = submissions(spark, d)
    first = O.commit_orders(carts.filter("submission_seq % 2 = 0"), spark.createDataFrame([], ORDERS), orderable(spark, d), BATCH_TIME)
    known = settle_table(first.orders, "stored")
    again = carts.unionByName(carts.filter("submission_seq % 5 = 0"))
    done = O.commit_orders(again, known, orderable(spark, d), BATCH_TIME)
    return done.outcomes.select("submission_seq", "outcome", "total_minor", "error_code")


def cart_validate(spark, d):
    return K.validate_carts(submissions(spark, d)).select("submission_seq", "key", "error_code", "error_message", "units")


def cart_fingerprint(spark, d):
    valid = K.validate_carts(submissions(spark, d)).filter("error_code IS NULL")
    return valid.select("submission_seq", "fingerprint", F.size("lines").cast("bigint").alias("lines"))


def price_carts(spark, d):
    checked = settle_table(K.validate_carts(submissions(spark, d)), "carts")
    priced = K.price_carts(checked.filter("error_code IS NULL"), orderable(spark, d))
    return priced.select("submission_seq", "price_error_code", F.col("total_minor").cast("bigint").alias("total_minor"))


def commit_outcomes(spark, d):
    return _commit(spark, d).outcomes.select("submission_seq", "outcome", "total_minor", "error_code")


def commit_orders(spark, d):
    return _commit(spark, d).orders.select("idempotency_key", "request_hash", "source", "total_minor")


def commit_items(spark, d):
    done = _commit(spark, d)
    keys = done.orders.select(F.col("id").alias("order_id"), F.col("idempotency_key").alias("key"))
    return done.items.join(keys, "order_id").select(
        "key", "line_no", "product_id", "product_name", "category", "unit_price_minor", "quantity", "size", "color"
    )


def order_readback(spark, d):
    lines = V.items(spark, d).withColumns({"size": F.lit(""), "color": F.lit("")})
    order = [F.col(c).asc() for c in ("product_id", "quantity", "unit_price_minor")]
    numbered = O.number_lines(lines, order)
    return O.read_orders(V.orders(spark, d), numbered).select(
        "order_id", "line_no", "product_id", "quantity", "unit_price_minor", "total_minor", "source", "currency"
    )


def _bags(spark, d):
    """One bag per supplier: thousands of lines, so the limit of 20 cuts them all."""
    return load_table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("cart_id"),
        F.struct("l_shipdate", "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.lit("").alias("size"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("color"),
    )


def sanitize_cart(spark, d):
    kept = K.sanitize_cart(_bags(spark, d))
    return kept.select("cart_id", "product_id", F.col("quantity").cast("bigint").alias("quantity"), "color")


def cart_subtotal(spark, d):
    catalog = active_catalog(
        V.products(spark, d), V.source_products(spark, d), V.unavailable(spark, d), V.retired(spark, d)
    )
    lines = V.items(spark, d).withColumnRenamed("order_id", "cart_id")
    return K.cart_subtotal(lines, catalog)


def cart_remainder(spark, d):
    """Bags per order; returned lines count as bought."""
    lines = load_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("cart_id"),
        F.col("l_partkey").alias("product_id"),
        F.lit("").alias("size"),
        F.col("l_linestatus").alias("color"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        "l_returnflag",
    )
    variant = ["cart_id", "product_id", "size", "color"]
    bags = lines.groupBy(*variant).agg(F.max("quantity").alias("quantity"))
    bought = lines.filter("l_returnflag = 'R'")
    return K.cart_remainder(bags, bought)


def _synth(spark, d):
    months = load_table(spark, d, "orders").groupBy(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).agg(F.count("*").alias("orders"))
    products = V.parts(spark, d).withColumns(
        {c: F.from_json(c, "array<string>") for c in ("sizes", "colors")}
    ).select(*CLEAN_PRODUCT.fieldNames())
    return O.synth_orders(products, months)


def synth_orders(spark, d):
    headers, _ = _synth(spark, d)
    return headers.select("id", "idempotency_key", "source", "total_minor", "created_at")


def synth_order_items(spark, d):
    _, lines = _synth(spark, d)
    return lines


def stream_orders(spark, d):
    """The order file as a stream of submissions, committed to the shared folder."""
    orders = load_table(spark, d, "orders")
    source = spark.readStream.schema(orders.schema).option("pathGlobFilter", "orders.parquet").parquet(d)
    root = scratch_path(spark, "intake")
    carts = submissions(spark, d, source.select("o_orderkey")).select(*SUBMISSIONS.fieldNames())
    intake.stream_orders(carts, orderable(spark, d), f"{root}/tables", f"{root}/checkpoint").awaitTermination()
    return intake.stored_orders(spark, f"{root}/tables").select("idempotency_key", "request_hash", "total_minor")


def stream_orders_batches(spark, d):
    """Four files as four batches, by order number modulo four; the last one delivers the first one's rows again."""
    orders = load_table(spark, d, "orders").select("o_orderkey")
    root = scratch_path(spark, "intake")
    for n in range(4):
        again = " OR o_orderkey % 4 = 0" if n == 3 else ""
        orders.filter(f"o_orderkey % 4 = {n}{again}").coalesce(1).write.mode("append").parquet(f"{root}/in")
    source = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    carts = submissions(spark, d, source).select(*SUBMISSIONS.fieldNames())
    intake.stream_orders(carts, orderable(spark, d), f"{root}/tables", f"{root}/checkpoint").awaitTermination()
    return intake.stored_orders(spark, f"{root}/tables").select("idempotency_key", "request_hash", "total_minor")


def stream_monthly(spark, d):
    """Order headers as a stream against the totals of their lines."""
    orders = load_table(spark, d, "orders")
    source = spark.readStream.schema(orders.schema).option("pathGlobFilter", "orders.parquet").parquet(d)
    headers = source.select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("synthetic")).otherwise(F.lit("visitor")).alias("source"),
        F.col("o_orderdate").alias("created_at"),
    )
    facts = headers.join(order_totals(V.items(spark, d)), "order_id")
    root = scratch_path(spark, "monthly")
    intake.stream_monthly(facts, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return intake.current_monthly(spark, f"{root}/table")


QUERIES = {
    "cart_validate": cart_validate,
    "cart_fingerprint": cart_fingerprint,
    "price_carts": price_carts,
    "commit_outcomes": commit_outcomes,
    "commit_orders": commit_orders,
    "commit_items": commit_items,
    "order_readback": order_readback,
    "sanitize_cart": sanitize_cart,
    "cart_subtotal": cart_subtotal,
    "cart_remainder": cart_remainder,
    "synth_orders": synth_orders,
    "synth_order_items": synth_order_items,
    "stream_orders": stream_orders,
    "stream_monthly": stream_monthly,
    "commit_against_stored": commit_against_stored,
    "stream_orders_batches": stream_orders_batches,
}

_CARTS = with_views("p", "u", "r", body=f"""
    , sub AS (SELECT *, md5(CAST(b AS VARCHAR)) AS h, (SELECT count(*) FROM part) AS n
        FROM ({_SEEDED.format(seeds=_SEEDS.format(orders='orders'))}) y),
    cart AS (SELECT *, {_KEY} AS key, CASE WHEN q % 37 = 0 THEN 'body' WHEN q % 31 = 0 THEN 'quantity' END AS bad FROM sub),
    line AS (SELECT q, s, n, bad, unnest(range(1, CAST(2 + s % 4 AS BIGINT))) AS j FROM cart),
    item AS (SELECT q, {_PRODUCT.format(text='VARCHAR')} AS product_id, CAST(sum({_QUANTITY}) AS BIGINT) AS quantity
        FROM line WHERE bad IS NULL GROUP BY 1, 2),
    offer AS (SELECT 'part-' || CAST(id AS VARCHAR) AS id, name, category, price_minor, sizes FROM p
        WHERE id NOT IN (SELECT id FROM u) AND id NOT IN (SELECT product_id FROM r)),
    priced AS (SELECT item.q, item.product_id, quantity, offer.name, offer.category, offer.price_minor,
        CASE WHEN offer.id IS NULL THEN 'invalid_product' WHEN offer.sizes = '' THEN 'invalid_variant' END AS problem
        FROM item LEFT JOIN offer ON offer.id = item.product_id),
    total AS (SELECT q, arg_min(problem, product_id) FILTER (problem IS NOT NULL) AS problem,
        CASE WHEN count(problem) = 0 THEN CAST(sum(quantity * price_minor) AS BIGINT) END AS total_minor,
        sha256('[' || string_agg('{{"color":"","product_id":"' || product_id || '","quantity":'
            || CAST(quantity AS VARCHAR) || ',"size":"M"}}', ',' ORDER BY product_id) || ']') AS fingerprint,
        count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units FROM priced GROUP BY q),
    winner AS (SELECT key, min(total.q) AS q FROM total JOIN cart ON cart.q = total.q
        WHERE total.problem IS NULL GROUP BY key),
    answer AS (SELECT cart.q, cart.key, cart.bad, t.problem, t.fingerprint, winner.q AS first,
        w.fingerprint AS known, w.total_minor AS total,
        CASE WHEN cart.bad IS NOT NULL THEN 'refused' WHEN winner.q = cart.q THEN 'created'
            WHEN cart.q > winner.q AND t.fingerprint = w.fingerprint THEN 'replayed'
            WHEN cart.q > winner.q THEN 'conflict' ELSE 'refused' END AS outcome
        FROM cart LEFT JOIN total t ON t.q = cart.q LEFT JOIN winner ON winner.key = cart.key
        LEFT JOIN total w ON w.q = winner.q) """)
_SYNTH = with_views("parts", body="""
    , m AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, count(*) AS c
        FROM orders GROUP BY 1, 2),
    num AS (SELECT y, m, unnest(range(1, c + 1)) AS n FROM m),
    l AS (SELECT *, unnest(range(0, 1 + n % 3)) AS f FROM num),
    k AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS rank FROM parts),
    pick AS (SELECT 'demo-' || printf('%04d%02d', y, m) || '-' || printf('%03d', n) AS order_id, y, m, n, f,
        1 + (m + n + f) % 3 AS quantity, k.* FROM l
        JOIN k ON k.rank = (m * 7 + n * 3 + f * 5) % (SELECT count(*) FROM parts)) """)

ORACLE = {
    "cart_validate": _CARTS + """SELECT cart.q AS submission_seq, CASE WHEN bad IS NULL THEN key END AS key,
        CASE WHEN bad IS NOT NULL THEN 'invalid_request' END AS error_code,
        CASE bad WHEN 'body' THEN 'Send only an items list; no customer or payment details are needed.'
            WHEN 'quantity' THEN 'Each quantity must be a whole number from 1 to 10.' END AS error_message, units
        FROM cart LEFT JOIN total ON total.q = cart.q""",
    "cart_fingerprint": _CARTS + "SELECT q AS submission_seq, fingerprint, lines FROM total",
    "price_carts": _CARTS + "SELECT q AS submission_seq, problem AS price_error_code, total_minor FROM total",
    "commit_outcomes": _CARTS + """SELECT q AS submission_seq, outcome,
        CASE WHEN outcome IN ('created', 'replayed') THEN total END AS total_minor,
        CASE WHEN bad IS NOT NULL THEN 'invalid_request' WHEN outcome = 'conflict' THEN 'idempotency_conflict'
            WHEN outcome = 'refused' THEN problem END AS error_code FROM answer""",
    "commit_orders": _CARTS + """SELECT key AS idempotency_key, fingerprint AS request_hash, 'visitor' AS source,
        total AS total_minor FROM answer WHERE outcome = 'created'""",
    "commit_items": _CARTS + """SELECT key, CAST(row_number() OVER (PARTITION BY a.q ORDER BY product_id) AS INTEGER) AS line_no,
        product_id, name AS product_name, category, price_minor AS unit_price_minor, CAST(quantity AS INTEGER) AS quantity,
        'M' AS size, '' AS color FROM answer a JOIN priced ON priced.q = a.q WHERE outcome = 'created'""",
    "order_readback": with_views("o", "i", body="""
        SELECT order_id, row_number() OVER (PARTITION BY order_id ORDER BY product_id, quantity, unit_price_minor) AS line_no,
            product_id, quantity, unit_price_minor, total_minor, source, 'INR' AS currency
        FROM i JOIN o ON o.id = i.order_id"""),
    "sanitize_cart": """SELECT l_suppkey AS cart_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
            l_returnflag AS color FROM lineitem WHERE l_returnflag <> 'N' AND l_quantity BETWEEN 1 AND 10
        QUALIFY row_number() OVER (PARTITION BY l_suppkey
            ORDER BY l_shipdate, l_orderkey, l_partkey, l_quantity, l_extendedprice) <= 20""",
    "cart_subtotal": with_views("i", "c", body="""
        SELECT order_id AS cart_id, CASE WHEN count(price_minor) = count(*)
            THEN CAST(sum(quantity * price_minor) AS BIGINT) END AS subtotal_minor
        FROM i LEFT JOIN c ON c.id = i.product_id GROUP BY order_id"""),
    "cart_remainder": """SELECT l_orderkey AS cart_id, l_partkey AS product_id, '' AS size, l_linestatus AS color,
            greatest(0, CAST(max(l_quantity) AS BIGINT)
                - CAST(coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS BIGINT)) AS quantity
        FROM lineitem GROUP BY 1, 2, 4 HAVING quantity > 0""",
    "synth_orders": _SYNTH + """SELECT order_id AS id, 'seed-' || order_id AS idempotency_key, 'synthetic' AS source,
        CAST(sum(price_minor * quantity) AS BIGINT) AS total_minor,
        printf('%04d-%02d-%02dT12:00:00Z', y, m, least(n * 3, 24)) AS created_at FROM pick GROUP BY order_id, y, m, n""",
    "synth_order_items": _SYNTH + """SELECT order_id, CAST(f + 1 AS INTEGER) AS line_no, id AS product_id,
        name AS product_name, category, price_minor AS unit_price_minor, CAST(quantity AS INTEGER) AS quantity,
        CASE WHEN sizes = '' THEN NULL ELSE 'S' END AS size, colors AS color FROM pick""",
    "commit_against_stored": _CARTS + """, good AS (SELECT cart.q, cart.key, t.fingerprint, t.total_minor
            FROM total t JOIN cart ON cart.q = t.q WHERE t.problem IS NULL),
        old AS (SELECT key, arg_min(fingerprint, q) AS known, arg_min(total_minor, q) AS total FROM good WHERE q % 2 = 0 GROUP BY key),
        new AS (SELECT key, min(q) AS q, arg_min(fingerprint, q) AS known, arg_min(total_minor, q) AS total FROM good
            WHERE key NOT IN (SELECT key FROM old) GROUP BY key),
        judged AS (SELECT cart.q, cart.bad, t.problem, coalesce(old.total, new.total) AS total,
            CASE WHEN cart.bad IS NOT NULL THEN 'refused'
                WHEN old.key IS NOT NULL THEN CASE WHEN t.fingerprint = old.known THEN 'replayed' ELSE 'conflict' END
                WHEN new.q = cart.q THEN 'created'
                WHEN cart.q > new.q AND t.fingerprint = new.known THEN 'replayed'
                WHEN cart.q > new.q THEN 'conflict' ELSE 'refused' END AS outcome
            FROM cart LEFT JOIN total t ON t.q = cart.q LEFT JOIN old ON old.key = cart.key LEFT JOIN new ON new.key = cart.key)
        SELECT q AS submission_seq, outcome, CASE WHEN outcome IN ('created', 'replayed') THEN total END AS total_minor,
            CASE WHEN bad IS NOT NULL THEN 'invalid_request' WHEN outcome = 'conflict' THEN 'idempotency_conflict'
                WHEN outcome = 'refused' THEN problem END AS error_code FROM judged""",
    "stream_orders_batches": _CARTS + """, good AS (SELECT cart.q, cart.key, t.fingerprint, t.total_minor,
            (cart.q % 4) * 1000000000 + cart.q AS turn FROM total t JOIN cart ON cart.q = t.q WHERE t.problem IS NULL)
        SELECT key AS idempotency_key, arg_min(fingerprint, turn) AS request_hash, arg_min(total_minor, turn) AS total_minor
        FROM good GROUP BY key""",
    "stream_orders": _CARTS + """SELECT key AS idempotency_key, fingerprint AS request_hash, total AS total_minor
        FROM answer WHERE outcome = 'created'""",
    "stream_monthly": with_views("o", "i", body="""
        SELECT strftime(o.created_at, '%Y-%m') AS month, source, count(DISTINCT o.id) AS orders,
            CAST(sum(unit_price_minor * quantity) AS BIGINT) AS revenue_minor, CAST(sum(quantity) AS BIGINT) AS units
        FROM o JOIN i ON i.order_id = o.id GROUP BY 1, 2"""),
}
