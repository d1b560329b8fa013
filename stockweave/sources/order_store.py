"""Headers and lines stored by bucket of the order id, so that their joins move no rows.

Both tables are written with the same number of buckets. A join or an aggregate on the order id
then reads the same bucket of both in one task, without an exchange on either side. Writing
deals rows with a rebalance hint, so AQE cuts a bucket that a hot order fills into several files;
reading such a bucket is one longer task that streams through it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


def _store(rows: DataFrame, table: str, path: str, key: str, sort: tuple[str, ...], buckets: int) -> None:
    writer = rows.hint("rebalance", buckets, F.col(key)).write.format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key, *sort).mode("errorifexists").saveAsTable(table)


def store_orders(orders: DataFrame, items: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> None:
    """Write `orders` (id, ...) and `items` (order_id, ...) under `path` and register them as name_orders and name_items."""
    _store(orders, f"{name}_orders", f"{path}/orders", "id", (), buckets)
    lines = tuple(c for c in ("line_no",) if c in items.columns)
    _store(items, f"{name}_items", f"{path}/items", "order_id", lines, buckets)


def register_orders(spark: SparkSession, orders, items, name: str, path: str, buckets: int = BUCKETS) -> None:
    """Make tables that `store_orders` wrote known to another session; `orders` and `items` are their schemas."""
    for table, schema, key in (("orders", orders, "id"), ("items", items, "order_id")):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE `{name}_{table}` ({columns}) USING parquet OPTIONS (path '{path}/{table}') "
            f"CLUSTERED BY (`{key}`) INTO {int(buckets)} BUCKETS"
        )


def open_orders(spark: SparkSession, name: str) -> tuple[DataFrame, DataFrame]:
    return spark.table(f"{name}_orders"), spark.table(f"{name}_items")


def read_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """`operators.orders.read_orders` over bucketed tables: rows stay where they are and are sorted in place."""
    headers = orders.select(F.col("id").alias("order_id"), "total_minor", "source", "created_at", F.lit("INR").alias("currency"))
    return items.join(headers, "order_id").sortWithinPartitions("order_id", "line_no")
