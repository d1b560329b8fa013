"""Cart submissions: validation, combined lines, fingerprint, pricing, bag helpers.

A submission is one row of at most 16 KiB, so validation, combining, numbering
and the fingerprint are expressions on that row: no shuffle until prices are
looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.functions import identity, text
from stockweave.operators.shape import fixed
from stockweave.schemas import MAX_BODY_BYTES, MAX_LINES, MAX_QUANTITY, MAX_UNITS, MAX_VARIANT_TEXT

# Messages of the checks.
KEY_MISSING = "Send a UUID Idempotency-Key header for this checkout."
KEY_INVALID = "Send a valid UUID Idempotency-Key header."
BODY_KEYS = "Send only an items list; no customer or payment details are needed."
LINE_COUNT = f"An order must contain 1 to {MAX_LINES} item lines."
LINE_KEYS = "Each item accepts only product_id, quantity, size and color."
PRODUCT_ID = "Each item needs a valid product_id."
QUANTITY = f"Each quantity must be a whole number from 1 to {MAX_QUANTITY}."
VARIANT_TEXT = "Each {} must be a string of 60 characters or fewer."
PER_VARIANT = f"A product variant may have at most {MAX_QUANTITY} units."
PER_ORDER = f"An order may contain at most {MAX_UNITS} units."
TOO_LARGE = "Checkout payload is too large."
BAD_JSON = "Send valid JSON for this checkout."
UNAVAILABLE = "Your cart contains an unavailable product. Refresh the catalog."
ITEM_FIELDS = ("product_id", "quantity", "size", "color")


def _no_null(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


OBJECT = "map<string,variant>"


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _string(value: Column) -> Column:
    return F.when(_kind(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _variant_text(value: Column) -> Column:
    """The text of size or color: absent is empty, anything but a string NULL."""
    return F.when(value.isNull(), F.lit("")).otherwise(_string(value))


def _typed_line(line: Column) -> Column:
    """Typed values of a line (NULL for anything but an object); a value of the wrong type is NULL."""
    known = F.size(F.array_except(F.map_keys(line), F.array(*[F.lit(f) for f in ITEM_FIELDS]))) == 0
    quantity = line["quantity"]
    return F.struct(
        _no_null(known).alias("known"),
        _string(line["product_id"]).alias("product_id"),
        F.when(_kind(quantity) == "BIGINT", F.try_variant_get(quantity, "$", "bigint")).alias("quantity"),
        _variant_text(line["size"]).alias("size"),
        _variant_text(line["color"]).alias("color"),
    )


def _checked_line(line: Column) -> Column:
    """A typed line with its own first problem."""
    problem = (
        F.when(~line["known"], F.lit(LINE_KEYS))
        .when(~_no_null(line["product_id"].rlike(identity.CART_PRODUCT_ID)), F.lit(PRODUCT_ID))
        .when(~_no_null(line["quantity"].between(1, MAX_QUANTITY)), F.lit(QUANTITY))
    )
    for field in ("size", "color"):
        problem = problem.when(
            ~_no_null(F.length(line[field]) <= MAX_VARIANT_TEXT), F.lit(VARIANT_TEXT.format(field))
        )
    return F.struct(
        F.struct(
            line["product_id"].alias("product_id"),
            text.strip(line["size"]).alias("size"),
            text.strip(line["color"]).alias("color"),
        ).alias("variant"),
        line["quantity"].alias("quantity"),
        problem.alias("problem"),
    )


def _parse_lines(items: Column) -> Column:
    """All fields of a line leave the VARIANT in one cast, which also gives its keys: paths and JSON texts are slow."""
    with_fields = F.transform(items, lambda i: F.try_variant_get(i, "$", OBJECT))
    return F.transform(F.transform(with_fields, _typed_line), _checked_line)


def _units(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0).cast("bigint"), lambda total, x: total + F.coalesce(x["quantity"], F.lit(0)))


def _same_variant(lines: Column, variant: Column) -> Column:
    return F.filter(lines, lambda x: x["variant"] == variant)


def validate_carts(submissions: DataFrame) -> DataFrame:
    """Adds error_code and error_message (the first problem), or key, lines, units, fingerprint.

    `lines` is sorted by product, size and color, numbered from 1, each variant once.
    """
    rows = submissions.withColumn("_doc", F.try_parse_json("body"))
    rows = rows.withColumn("key", identity.canonical_uuid("idempotency_key"))
    rows = rows.withColumn("_items", F.try_variant_get("_doc", "$.items", "array<variant>"))
    countable = _no_null(F.size("_items").between(1, MAX_LINES))
    rows = rows.withColumn("_parsed", F.when(countable, _parse_lines(F.col("_items"))))
    parsed = F.col("_parsed")
    # the running sum per variant is checked line by line, after the line itself; each
    # line alone is within the limit, so only carts that repeat a variant need it
    repeats = F.size(F.array_distinct(F.transform(parsed, lambda x: x["variant"]))) < F.size(parsed)
    running = lambda line, i: _units(_same_variant(F.slice(parsed, F.lit(1), i + 1), line["variant"]))
    checked = F.transform(
        parsed,
        lambda line, i: F.coalesce(line["problem"], F.when(running(line, i) > MAX_QUANTITY, F.lit(PER_VARIANT))),
    )
    problems = F.when(repeats, checked).otherwise(F.transform(parsed, lambda line: line["problem"]))
    body_keys = F.map_keys(F.try_variant_get("_doc", "$", OBJECT))
    key_text = text.blank_if_null("idempotency_key")
    too_large = F.octet_length("body") > MAX_BODY_BYTES
    message = (
        F.when(too_large, F.lit(TOO_LARGE))
        .when(F.col("_doc").isNull(), F.lit(BAD_JSON))
        .when(F.length(key_text) != 36, F.lit(KEY_MISSING))
        .when(F.col("key").isNull(), F.lit(KEY_INVALID))
        .when(~_no_null(body_keys == F.array(F.lit("items"))), F.lit(BODY_KEYS))
        .when(~countable, F.lit(LINE_COUNT))
        .otherwise(
            F.coalesce(
                F.try_element_at(F.filter(problems, lambda p: p.isNotNull()), F.lit(1)),
                F.when(_units(parsed) > MAX_UNITS, F.lit(PER_ORDER)),
            )
        )
    )
    rows = rows.withColumn("error_message", message)
    pair = lambda v, units: F.struct(v.alias("variant"), units.alias("quantity"))
    # lines of one variant are added up; most carts name each variant once and keep their lines
    summed = F.transform(
        F.array_distinct(F.transform(parsed, lambda x: x["variant"])), lambda v: pair(v, _units(_same_variant(parsed, v)))
    )
    units = F.when(repeats, summed).otherwise(F.transform(parsed, lambda x: pair(x["variant"], x["quantity"])))
    lines = F.transform(
        F.sort_array(units),
        lambda x, i: F.struct(
            (i + 1).alias("line_no"),
            x["variant"]["product_id"].alias("product_id"),
            x["variant"]["size"].alias("size"),
            x["variant"]["color"].alias("color"),
            x["quantity"].alias("quantity"),
        ),
    )
    valid = F.col("error_message").isNull()
    rows = rows.withColumn("lines", F.when(valid, lines))
    # as a column of its own the text is made once, though the hash names it several times
    rows = rows.withColumn("_json", F.when(valid, identity.cart_json("lines")))
    code = (
        F.when(valid, F.lit(None).cast("string"))
        .when(too_large, F.lit("request_too_large"))
        .when(F.col("_doc").isNull(), F.lit("invalid_json"))
        .otherwise(F.lit("invalid_request"))
    )
    rows = rows.withColumn("error_code", code)
    return fixed(
        rows,
        list(submissions.columns),
        {
            "key": F.when(valid, F.col("key")),
            "error_code": F.col("error_code"),
            "error_message": F.col("error_message"),
            "lines": F.col("lines"),
            "units": F.when(valid, F.aggregate("lines", F.lit(0).cast("bigint"), lambda t, x: t + x["quantity"])),
            "fingerprint": F.when(valid, identity.fingerprint("_json")),
        },
    )


def _variant_problem(field: str, options: str) -> Column:
    value = F.col(f"line.{field}")
    offered = F.size(options) > 0
    wrong = (offered & ~F.array_contains(options, value)) | (~offered & (value != ""))
    return F.when(wrong, F.concat(F.lit(f"Choose an available {field} for "), "name", F.lit(".")))


def price_carts(carts: DataFrame, products: DataFrame, unique: bool = False) -> DataFrame:
    """Price valid carts from orderable products; per cart priced lines and total, or the first bad line.

    `carts` has submission_seq, key, fingerprint, lines. Lines of a bestseller
    sit on the many side of the product join, which AQE splits; regrouping then
    is per cart, at most 20 lines each. `unique` tells that no cart comes twice.
    """
    # a cart that was delivered twice is priced once: its lines meet again by these columns
    once = carts.select("submission_seq", "key", "fingerprint", "lines")
    if not unique:
        once = once.dropDuplicates(["submission_seq", "key", "fingerprint"])
    lines = once.select("submission_seq", "key", "fingerprint", F.explode("lines").alias("line"))
    offers = products.select(
        F.col("id").alias("_id"),
        "name",
        "category",
        "price_minor",
        F.col("sizes").alias("_sizes"),
        F.col("colors").alias("_colors"),
    )
    joined = lines.join(offers, F.col("line.product_id") == F.col("_id"), "left")
    gone = F.when(F.col("_id").isNull(), F.lit(UNAVAILABLE))
    problem = F.coalesce(gone, _variant_problem("size", "_sizes"), _variant_problem("color", "_colors"))
    code = F.when(F.col("_id").isNull(), F.lit("invalid_product")).otherwise(F.lit("invalid_variant"))
    joined = joined.withColumn("_problem", problem)
    bad = F.when(
        F.col("_problem").isNotNull(),
        F.struct(F.col("line.line_no").alias("line_no"), code.alias("code"), F.col("_problem").alias("message")),
    )
    priced = F.struct(
        F.col("line.line_no").cast("int").alias("line_no"),
        F.col("line.product_id").alias("product_id"),
        F.col("name").alias("product_name"),
        F.col("category").alias("category"),
        F.col("price_minor").alias("unit_price_minor"),
        F.col("line.quantity").cast("int").alias("quantity"),
        F.col("line.size").alias("size"),
        F.col("line.color").alias("color"),
    )
    return (
        joined.groupBy("submission_seq", "key", "fingerprint")
        .agg(
            F.min(bad).alias("_bad"),
            F.sum(F.col("line.quantity") * F.col("price_minor")).alias("_total"),
            F.array_sort(F.collect_list(priced)).alias("_priced"),
        )
        .select(
            "submission_seq",
            "key",
            "fingerprint",
            F.col("_bad.code").alias("price_error_code"),
            F.col("_bad.message").alias("price_error_message"),
            F.when(F.col("_bad").isNull(), F.col("_total")).alias("total_minor"),
            F.when(F.col("_bad").isNull(), F.col("_priced")).alias("priced"),
        )
    )


def cart_subtotal(lines: DataFrame, catalog: DataFrame, cart: str = "cart_id") -> DataFrame:
    """Total per bag; NULL when any line has no price."""
    prices = catalog.select(F.col("id").alias("product_id"), "price_minor")
    priced = lines.select(cart, "product_id", "quantity").join(prices, "product_id", "left")
    total = F.sum(F.col("quantity") * F.col("price_minor"))
    complete = F.count("price_minor") == F.count("*")
    return priced.groupBy(cart).agg(F.when(complete, total).cast("bigint").alias("subtotal_minor"))


def sanitize_cart(lines: DataFrame, cart: str = "cart_id", order: str = "line_no") -> DataFrame:
    """Well-formed lines only, the first 20 of each bag (a group limit: 20 rows per bag leave a task)."""
    whole = F.col("quantity") == F.floor("quantity")
    well_formed = (
        F.col("product_id").isNotNull()
        & F.col("size").isNotNull()
        & F.col("color").isNotNull()
        & whole
        & F.col("quantity").between(1, MAX_QUANTITY)
    )
    first = Window.partitionBy(cart).orderBy(order)
    numbered = lines.filter(well_formed).withColumn("_n", F.row_number().over(first))
    return numbered.filter(F.col("_n") <= MAX_LINES).drop("_n")


def cart_remainder(cart_lines: DataFrame, purchased: DataFrame, cart: str = "cart_id") -> DataFrame:
    """The bag after a purchase: quantities per variant go down to zero, empty lines leave."""
    identity_columns = [cart, "product_id", "size", "color"]
    bought = purchased.groupBy(*identity_columns).agg(F.sum("quantity").alias("_bought"))
    left = F.greatest(F.lit(0), F.col("quantity") - F.coalesce("_bought", F.lit(0)))
    return (
        cart_lines.join(bought, identity_columns, "left")
        .withColumn("quantity", left.cast("bigint"))
        .drop("_bought")
        .filter("quantity > 0")
    )
