"""Every rule broken on purpose, by rows of the part and order tables: constraints, cart errors, control characters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.operators import carts as K
from stockweave.operators import cleaning as L
from stockweave.operators import quality as Q
from stockweave.plans import views as V
from stockweave.plans.checkout import _KEY
from stockweave.plans.cleaning import raw_parts
from stockweave.sources.tables import load_spread, load_table

# What breaks a rule, by table: the column and the value it gets in every row whose number is the
# rule's place in the list.
_PRODUCT = (
    ("name_required", "name", "NULL"),
    ("category_required", "category", "NULL"),
    ("image_required", "image", "NULL"),
    ("alt_required", "alt", "NULL"),
    ("sizes_required", "sizes", "NULL"),
    ("colors_required", "colors", "NULL"),
    ("featured_required", "featured", "NULL"),
    ("name_length", "name", "repeat('n', 121)"),
    ("featured_flag", "featured", "2"),
    ("category_known", "category", "'toys'"),
    ("mrp_positive", "mrp_minor", "0D"),
    ("discount_range", "discount_percent", "101"),
    ("rating_value_range", "rating_value", "-0.5D"),
    ("rating_scale_range", "rating_scale", "0D"),
    ("rating_count_range", "rating_count", "-1L"),
    ("sizes_is_list", "sizes", "'{}'"),
    ("colors_is_list", "colors", "'S'"),
    ("missing_fields_is_list", "missing_fields", "'1'"),
)
_PRICED = (
    *_PRODUCT,
    ("description_required", "description", "NULL"),
    ("price_minor_required", "price_minor", "NULL"),
    ("price_range", "price_minor", "100000001D"),
    ("price_whole", "price_minor", "1.5D"),
)
_UNPRICED = (
    *_PRODUCT,
    ("source_store_required", "source_store", "NULL"),
    ("canonical_url_required", "canonical_url", "NULL"),
    ("verification_status_required", "verification_status", "NULL"),
    ("missing_fields_required", "missing_fields", "NULL"),
    ("price_absent", "price_minor", "5D"),
)
_ORDER = (
    ("id_required", "id", "NULL"),
    ("idempotency_key_required", "idempotency_key", "NULL"),
    ("request_hash_required", "request_hash", "NULL"),
    ("source_required", "source", "NULL"),
    ("total_minor_required", "total_minor", "NULL"),
    ("created_at_required", "created_at", "NULL"),
    ("source_known", "source", "'phone'"),
    ("total_range", "total_minor", "-1D"),
)
_ITEM = (
    *((f"{c}_required", c, "NULL") for c in ("order_id", "line_no", "product_id", "product_name", "category", "unit_price_minor", "quantity")),
    ("line_no_range", "line_no", "0"),
    ("category_known", "category", "'toys'"),
    ("unit_price_range", "unit_price_minor", "0D"),
    ("unit_price_whole", "unit_price_minor", "1.5D"),
    ("quantity_range", "quantity", "11D"),
    ("quantity_whole", "quantity", "1.5D"),
)
_MARK = (("id_required", "id", "NULL"), ("reason_required", "reason", "NULL"))
_GONE = tuple((f"{c}_required", c, "NULL") for c in ("product_id", "name", "failure_reason", "retired_at"))
_TABLES = {"products": _PRICED, "source_products": _UNPRICED, "orders": _ORDER, "order_items": _ITEM,
           "unavailable": _MARK, "retired": _GONE}


def _broken(rows: DataFrame, faults: tuple) -> DataFrame:
    """`rows` (n, more) with one fault per row; every last place of the round stays sound."""
    place = F.col("n") % (len(faults) + 1)
    columns = {c for _, c, _ in faults}
    for column in columns:
        value = F.col(column)
        for at, (_, name, bad) in enumerate(faults):
            if name == column:
                value = F.when(place == at, F.expr(bad)).otherwise(value)
        rows = rows.withColumn(column, value)
    return rows


def every_constraint(spark, d):
    parts = V.parts(spark, d).withColumns({"n": F.col("id"), "price_minor": F.col("price_minor").cast("double"),
                                           "mrp_minor": F.lit(None).cast("double"), "featured": F.col("featured").cast("int")})
    numbered = load_table(spark, d, "part").select(F.col("p_partkey").alias("n"))
    text = F.col("n").cast("string")
    orders = numbered.select("n", text.alias("id"), text.alias("idempotency_key"), text.alias("request_hash"),
                             F.lit("visitor").alias("source"), F.lit(1.0).alias("total_minor"), F.lit("2026-01-01").alias("created_at"))
    items = numbered.select("n", text.alias("order_id"), F.lit(1).alias("line_no"), text.alias("product_id"), text.alias("product_name"),
                            F.lit("men").alias("category"), F.lit(5.0).alias("unit_price_minor"), F.lit(2.0).alias("quantity"))
    marks = numbered.select("n", text.alias("id"), F.lit("r").alias("reason"))
    gone = numbered.select("n", *[text.alias(c) for c in ("product_id", "name", "failure_reason", "retired_at")])
    tables = {
        "products": (parts, Q.product_rules(lists_as_json=True)),
        "source_products": (parts.withColumn("price_minor", F.lit(None).cast("double")), Q.product_rules(unpriced=True, lists_as_json=True)),
        "orders": (orders, Q.order_rules()),
        "order_items": (items, Q.order_item_rules()),
        "unavailable": (marks, Q.unavailable_rules()),
        "retired": (gone, Q.retired_rules()),
    }
    found = [
        Q.check_constraints(_broken(rows, _TABLES[name]), ["n"], rules).withColumn("table", F.lit(name))
        for name, (rows, rules) in tables.items()
    ]
    return reduce(DataFrame.unionByName, found)


_LINE = '{"product_id":"p-%s","quantity":%s,"size":"M"}'
# by order number modulo the length: idempotency key, body, code and message
_KEY_OK = None
_CARTS = (
    (_KEY_OK, '{"items":[' + _LINE % (1, 1) + "]}", None, None),
    (_KEY_OK, " " * 20_000, "request_too_large", K.TOO_LARGE),
    (_KEY_OK, "{", "invalid_json", K.BAD_JSON),
    ("", '{"items":[' + _LINE % (1, 1) + "]}", "invalid_request", K.KEY_MISSING),
    ("x" * 36, '{"items":[' + _LINE % (1, 1) + "]}", "invalid_request", K.KEY_INVALID),
    (_KEY_OK, '{"items":[' + _LINE % (1, 1) + '],"email":"x"}', "invalid_request", K.BODY_KEYS),
    (_KEY_OK, '{"items":[]}', "invalid_request", K.LINE_COUNT),
    (_KEY_OK, '{"items":[{"product_id":"p","quantity":1,"price":5}]}', "invalid_request", K.LINE_KEYS),
    (_KEY_OK, '{"items":[{"product_id":"Not An Id","quantity":1}]}', "invalid_request", K.PRODUCT_ID),
    (_KEY_OK, '{"items":[' + _LINE % (1, 11) + "]}", "invalid_request", K.QUANTITY),
    (_KEY_OK, '{"items":[{"product_id":"p","quantity":1,"size":"' + "s" * 61 + '"}]}', "invalid_request", K.VARIANT_TEXT.format("size")),
    (_KEY_OK, '{"items":[{"product_id":"p","quantity":1,"color":5}]}', "invalid_request", K.VARIANT_TEXT.format("color")),
    (_KEY_OK, '{"items":[' + _LINE % (1, 6) + "," + _LINE % (1, 6) + "]}", "invalid_request", K.PER_VARIANT),
    (_KEY_OK, '{"items":[' + ",".join(_LINE % (n, 10) for n in range(6)) + "]}", "invalid_request", K.PER_ORDER),
)


def every_cart_error(spark, d):
    place = F.col("o_orderkey") % len(_CARTS)
    own = F.expr(_KEY.replace("h,", "md5(CAST(o_orderkey AS STRING)),"))
    key, body = own, F.lit(None).cast("string")
    for at, (other, text, _, _) in enumerate(_CARTS):
        key = F.when(place == at, F.lit(other)).otherwise(key) if other is not None else key
        body = F.when(place == at, F.lit(text)).otherwise(body)
    rows = load_spread(spark, d, "orders", "o_orderkey").select(
        F.col("o_orderkey").alias("submission_seq"), key.alias("idempotency_key"), body.alias("body")
    )
    return K.validate_carts(rows).select("submission_seq", "error_code", "error_message")


# fields with a control character, by row number modulo seven
_CONTROL = (("name", "\u0000"), ("description", "\u0001"), ("alt", "\u007f"), ("sizes", "\u0008"), ("id", "\u001f"))


def control_characters(spark, d):
    rows = raw_parts(spark, d)
    for at, (field, char) in enumerate(_CONTROL):
        bad = F.concat(F.col(field), F.lit(char))
        rows = rows.withColumn(field, F.when(F.col("row") % 7 == at, bad).otherwise(F.col(field)))
    names = load_table(spark, d, "part").select(F.concat(F.lit("none-"), F.col("p_partkey").cast("string")).alias("name"))
    found = L.clean_catalog(rows, names).issues
    problems = F.filter("errors", lambda e: e.endswith(L.CONTROL_PROBLEM))
    return found.select("row", F.explode(problems).alias("problem"))


QUERIES = {
    "every_constraint": every_constraint,
    "every_cart_error": every_cart_error,
    "control_characters": control_characters,
}


def _constraint_sql(name: str, faults: tuple) -> str:
    rules = ", ".join(f"({at}, '{rule}')" for at, (rule, _, _) in enumerate(faults))
    return f"""SELECT p_partkey AS n, rule, '{name}' AS "table" FROM part
        JOIN (VALUES {rules}) f(place, rule) ON p_partkey % {len(faults) + 1} = place"""


def _text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


ORACLE = {
    "every_constraint": " UNION ALL ".join(_constraint_sql(name, faults) for name, faults in _TABLES.items()),
    "every_cart_error": f"""SELECT o_orderkey AS submission_seq, error_code, error_message FROM orders
        JOIN (VALUES {", ".join(f"({at}, {_text(c)}, {_text(m)})" for at, (_, _, c, m) in enumerate(_CARTS))})
            f(place, error_code, error_message) ON o_orderkey % {len(_CARTS)} = place""",
    "control_characters": f"""SELECT p_partkey + 2 AS "row", field || ' {L.CONTROL_PROBLEM}' AS problem FROM part
        JOIN (VALUES {", ".join(f"({at}, '{f}')" for at, (f, _) in enumerate(_CONTROL))}) c(place, field)
            ON (p_partkey + 2) % 7 = place""",
}
