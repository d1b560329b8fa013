"""Order intake and monthly sales as streams."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stockweave.operators.orders import commit_orders, key_bucket
from stockweave.schemas import ORDER_ITEMS, ORDERS


def stored(spark: SparkSession, root: str, name: str, schema: StructType, before: int | None = None) -> DataFrame:
    """Rows of all batches, or of the batches before one; the batch is a partition column."""
    try:
        rows = spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())])).parquet(f"{root}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    if before is not None:
        rows = rows.filter(F.col("batch_id") < before)
    return rows.select(*schema.fieldNames())


def stored_orders(spark: SparkSession, root: str, before: int | None = None, bucketed: bool = False) -> DataFrame:
    """Stored headers; `bucketed` with the bucket of their key, by which a reader can prune."""
    schema = StructType([*ORDERS.fields, StructField("bucket", StringType())]) if bucketed else ORDERS
    return stored(spark, root, "orders", schema, before)


def stored_items(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    return stored(spark, root, "items", ORDER_ITEMS, before)


def _append(rows: DataFrame, root: str, name: str, batch_id: int, *by: str) -> None:
    rows.write.mode("overwrite").partitionBy(*by).parquet(f"{root}/{name}/batch_id={batch_id}")


def stream_orders(submissions: DataFrame, products: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Exactly one order per key under retries, concurrent duplicates and batch replays.

    A batch looks at the orders of earlier batches only and writes its own
    folder: running it again overwrites the same rows. Orders are appended by the bucket of
    their key, the stored ones are never rewritten, and a batch reads the buckets of its keys.
    Intermediate tables go to one folder that every batch overwrites.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # a batch is as large as its trigger allows; its files may be few
        batch = batch.repartition(spark.sparkContext.defaultParallelism)
        now = datetime.now(timezone.utc).replace(microsecond=0, tzinfo=None)
        known = stored_orders(spark, root, before=batch_id, bucketed=True)
        done = commit_orders(batch, known, products, now, scratch=f"{root}/scratch")
        _append(done.items, root, "items", batch_id)
        _append(done.outcomes, root, "outcomes", batch_id)
        # rows of a bucket meet first, so that a batch writes one file per bucket
        headers = done.orders.withColumn("bucket", key_bucket()).repartition("bucket")
        _append(headers, root, "orders", batch_id, "bucket")

    writer = submissions.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def monthly_by_source(orders: DataFrame) -> DataFrame:
    """Running totals per month and source over order rows (created_at, source, revenue_minor, units).

    Late orders count in their own month, so nothing is dropped and no watermark is set;
    the state is one row per month and source.
    """
    month = F.substring(F.col("created_at").cast("string"), 1, 7)
    return orders.groupBy(month.alias("month"), "source").agg(
        F.count("*").alias("orders"),
        F.sum("revenue_minor").alias("revenue_minor"),
        F.sum("units").alias("units"),
    )


def stream_monthly(orders: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep the monthly table under `root`: a batch writes the months and sources it changed, and only those.

    A replayed batch overwrites its own rows. `compact_monthly` shortens what readers go through.
    """

    def merge(changed: DataFrame, batch_id: int) -> None:
        # not coalesce(1), which would run all parts of the state in one task; the rows are months times sources
        changed.repartition(1).write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    writer = monthly_by_source(orders).writeStream.outputMode("update").foreachBatch(merge)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


_MONTHLY = "month string, source string, orders bigint, revenue_minor bigint, units bigint, batch_id bigint"
_COMPACTED = "compacted"


def _changes(spark: SparkSession, root: str) -> DataFrame:
    """Changed rows with their batch: those of the last compaction and of the batches after it."""
    rows = spark.read.schema(_MONTHLY).option("basePath", root).parquet(f"{root}/batch_id=*")
    try:
        before = spark.read.schema(_MONTHLY + ", upto bigint").parquet(f"{root}/{_COMPACTED}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return rows
    last = before.agg(F.max("upto")).first()[0]
    return rows.filter(F.col("batch_id") > last).unionByName(before.filter(F.col("upto") == last).drop("upto"))


def current_monthly(spark: SparkSession, root: str) -> DataFrame:
    """The last totals of every month and source."""
    figures = F.struct("orders", "revenue_minor", "units")
    last = _changes(spark, root).groupBy("month", "source").agg(F.max_by(figures, "batch_id").alias("last"))
    return last.select("month", "source", "last.*")


def compact_monthly(spark: SparkSession, root: str) -> int:
    """Fold the changes of all batches into one folder; the batches stay until their owner removes them."""
    rows = _changes(spark, root)
    upto = rows.agg(F.max("batch_id")).first()[0]
    figures = F.struct("orders", "revenue_minor", "units", "batch_id")
    last = rows.groupBy("month", "source").agg(F.max_by(figures, "batch_id").alias("last"))
    last.select("month", "source", "last.*").repartition(1).write.mode("overwrite").parquet(f"{root}/{_COMPACTED}/upto={upto}")
    return upto
