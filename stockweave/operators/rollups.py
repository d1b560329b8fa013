"""Sales summaries kept as roll-ups: a batch adds its own sums, readers fold them.

A batch of new orders with all their lines gives one small table: per part (headers, months,
categories, products), entry and source the counts and sums that the summaries need. All of them add up,
so the table of a later batch never looks at earlier lines. A batch is a folder named by its number; running it again
overwrites the same rows. `compact` folds the batches up to one into a single folder,
which readers take instead. An order and its lines come in one batch, so orders per month add
up too. NULL figures count as nothing, like in the summaries themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.operators.analytics import POPULAR, month_of, order_totals, with_active_flag
from stockweave.schemas import ORDER_SOURCES

ROLLUP = (
    "part string, entry string, source string, orders long, units long, revenue_minor long, priced long, name string, category string"
)
_FIGURES = ("orders", "units", "revenue_minor", "priced")


def _part(part: str, entry, **figures) -> list[Column]:
    given = {**{f: F.lit(0) for f in _FIGURES}, "name": F.lit(None), "category": F.lit(None), **figures}
    kinds = dict.fromkeys(_FIGURES, "bigint")
    return [
        F.lit(part).alias("part"),
        F.col(entry).cast("string").alias("entry") if isinstance(entry, str) else entry.alias("entry"),
        "source",
        *[F.coalesce(value, F.lit(0)).cast("bigint").alias(c) if c in kinds else value.cast("string").alias(c) for c, value in given.items()],
    ]


def rollup(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The sums of a batch: `orders` (id, source, total_minor, created_at) and `items` with snapshots of name and category."""
    value = F.col("unit_price_minor") * F.col("quantity")
    headers = orders.select(F.col("id").alias("order_id"), "source", month_of().alias("month"))
    heads = orders.groupBy("source").agg(
        F.count("*").alias("n"), F.sum("total_minor").alias("total"), F.count("total_minor").alias("priced")
    )
    # summed per order, product and snapshot before the join, so that a hot order is one row a product. The name is
    # a key, not a largest text, which would cost a sort of all lines
    snapshot = ["product_id", "category", F.col("product_name").alias("name")]
    lines = items.groupBy("order_id", *snapshot).agg(F.sum("quantity").alias("units"), F.sum(value).alias("revenue"))
    # order ids are unique, so orders with lines are counted over the sums per order
    months = order_totals(items).join(headers, "order_id").groupBy("month", "source").agg(
        F.count("*").alias("n"), F.sum("units").alias("u"), F.sum("revenue_minor").alias("r")
    )
    sums = (F.sum("units").alias("u"), F.sum("revenue").alias("r"))
    # categories and products read all columns of these sums, so their exchange is made once and reused
    sold = lines.join(headers, "order_id").groupBy("product_id", "category", "name", "source")
    sold = sold.agg(F.sum("units").alias("units"), F.sum("revenue").alias("revenue"))
    categories = sold.groupBy("category", "source").agg(*sums)
    products = sold.groupBy("product_id", "source").agg(*sums, F.max("name").alias("name"), F.max("category").alias("category"))
    parts = [
        heads.select(*_part("headers", F.lit("all"), orders=F.col("n"), revenue_minor=F.col("total"), priced=F.col("priced"))),
        months.select(*_part("months", "month", orders=F.col("n"), units=F.col("u"), revenue_minor=F.col("r"))),
        categories.select(*_part("categories", "category", units=F.col("u"), revenue_minor=F.col("r"))),
        products.select(
            *_part("products", "product_id", units=F.col("u"), revenue_minor=F.col("r"), name=F.col("name"), category=F.col("category"))
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def fold(rows: DataFrame) -> DataFrame:
    """One row per part, entry and source."""
    sums = [F.sum(f).cast("bigint").alias(f) for f in _FIGURES]
    return rows.groupBy("part", "entry", "source").agg(*sums, F.max("name").alias("name"), F.max("category").alias("category"))


def _folder(spark: SparkSession, path: str, mark: str) -> DataFrame:
    try:
        return spark.read.schema(f"{ROLLUP}, {mark} long").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{ROLLUP}, {mark} long")


def add_batch(batch_id: int, orders: DataFrame, items: DataFrame, root: str) -> None:
    """Store the sums of a batch; a replay overwrites them."""
    # no coalesce(1): it would run the last step of every sum in one task
    rollup(orders, items).write.mode("overwrite").parquet(f"{root}/batches/batch_id={batch_id}")


def _current(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the last compaction and of the batches after it."""
    folded, batches = _folder(spark, f"{root}/folded", "upto"), _folder(spark, f"{root}/batches", "batch_id")
    last = folded.agg(F.max("upto")).first()[0]
    columns = [c for c in batches.columns if c != "batch_id"]
    if last is None:
        return batches.select(columns)
    kept = batches.filter(F.col("batch_id") > last).select(columns)
    return kept.unionByName(folded.filter(F.col("upto") == last).select(columns))


def compact(spark: SparkSession, root: str) -> int | None:
    """Fold all batches into one folder; the batches stay until their owner removes them."""
    last = _folder(spark, f"{root}/batches", "batch_id").agg(F.max("batch_id")).first()[0]
    if last is not None:
        fold(_current(spark, root)).write.mode("overwrite").parquet(f"{root}/folded/upto={last}")
    return last


def read_rollup(spark: SparkSession, root: str, source: str = "all") -> DataFrame:
    rows = fold(_current(spark, root))
    return rows if source == "all" else rows.filter(F.col("source") == source)


def dashboard(spark: SparkSession, root: str, catalog: DataFrame, source: str = "all", currency: str = "INR") -> DataFrame:
    """`analytics.analytics_table` from the roll-ups alone."""
    every = _current(spark, root)
    rows = every if source == "all" else every.filter(F.col("source") == source)

    def summed(part: str, *more: Column) -> DataFrame:
        sums = [F.sum(f).cast("bigint").alias(f) for f in _FIGURES]
        return rows.filter(F.col("part") == part).groupBy("entry").agg(*sums, *more)

    none = F.lit(None).cast("bigint")
    heads = rows.filter("part = 'headers'").agg(*[F.coalesce(F.sum(f), F.lit(0)).cast("bigint").alias(f) for f in _FIGURES])
    units = rows.filter("part = 'categories'").agg(F.coalesce(F.sum("units"), F.lit(0)).cast("bigint")).scalar()
    mean = F.when(F.col("priced") > 0, F.round(F.col("revenue_minor") / F.col("priced")).cast("bigint")).otherwise(F.lit(0))
    order = [F.desc("units"), F.desc("revenue_minor"), F.col("product_id")]
    kind = dict(catalog.dtypes)["id"]
    best = summed("products").withColumn("product_id", F.col("entry").cast(kind)).orderBy(*order).limit(POPULAR)
    known = spark.range(1).select(
        F.explode(F.array(*[F.lit(s) for s in ORDER_SOURCES])).alias("entry"), F.lit(0).cast("bigint").alias("orders")
    )
    sources = every.filter("part = 'headers'").select(F.col("source").alias("entry"), "orders").unionByName(known)
    flag = F.lit(None).cast("boolean")
    parts = (
        heads.select(F.lit("summary"), F.lit("all"), "orders", units, "revenue_minor", mean.cast("bigint"), flag),
        sources.groupBy("entry").agg(F.sum("orders").cast("bigint").alias("orders")).select(F.lit("source_counts"), "entry", "orders", none, none, none, flag),
        summed("months").select(F.lit("monthly"), "entry", "orders", "units", "revenue_minor", none, flag),
        summed("categories").select(F.lit("categories"), "entry", none, "units", "revenue_minor", none, flag),
        with_active_flag(best, catalog).select(F.lit("popular"), "entry", none, "units", "revenue_minor", none, "active"),
    )
    names = ("part", "entry", "orders", "units", "revenue_minor", "average_order_minor", "active")
    whole = reduce(DataFrame.union, [p.toDF(*names) for p in parts])
    return whole.select("*", F.lit(source).alias("source"), F.lit(currency).alias("currency"))
