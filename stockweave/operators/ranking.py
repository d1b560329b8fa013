"""Row numbers that never gather one group, or the whole table, in one task.

A plain `row_number()` window puts a group into a single task. Here rows are
range-partitioned on the full sort order, so a group of any size spreads over as
many slices as it needs; only per-slice totals are combined afterwards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.session import settle

# monotonically_increasing_id: partition number above, record number in the low 33 bits
_RECORD_BITS = 33


def rank_rows(rows: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Position 1..n of each row in the total order `order` (end it with a unique column)."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(ranged.withColumn("_at", F.monotonically_increasing_id()))
    sliced = placed.withColumn("_slice", F.shiftright("_at", _RECORD_BITS)).withColumn(
        "_at", F.col("_at").bitwiseAND(F.lit((1 << _RECORD_BITS) - 1))
    )
    sizes = sliced.groupBy("_slice").agg(F.count("*").alias("_rows"))
    # one row per slice, so this window and the broadcast hold a few thousand rows at most
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (
        sliced.join(F.broadcast(starts), "_slice")
        .withColumn(name, F.col("_start") + F.col("_at") + 1)
        .drop("_slice", "_at", "_start")
    )


def sums_before(rows: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """The sum of `value` over all earlier rows in the total order `order`, 0 for the first; no task gets all rows."""
    ranged = settle(rows.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()))
    earlier = lambda w: F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row per slice
    starts = ranged.groupBy("_slice").agg(F.sum(value).alias(value))
    starts = starts.select("_slice", earlier(Window.orderBy("_slice")).alias("_start"))
    within = ranged.withColumn(name, earlier(Window.partitionBy("_slice").orderBy(*order)))
    return within.join(F.broadcast(starts), "_slice").withColumn(name, F.col(name) + F.col("_start")).drop("_slice", "_start")


def _same_key(left: DataFrame, right: DataFrame, key: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right["_" + k]) for k in key])


def number_within(rows: DataFrame, key: list[str], order: list[Column], name: str = "line_no") -> DataFrame:
    """Number 1..n inside each key, in `order`; equal rows are numbered in any order."""
    by_key = [F.col(k) for k in key]
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(*by_key, *order, F.col("_tie"))
    ranged = settle(ranged.withColumn("_slice", F.spark_partition_id()))

    within_slice = Window.partitionBy("_slice", *key).orderBy(*order, F.col("_tie"))
    numbered = ranged.withColumn("_n", F.row_number().over(within_slice))

    # Slices follow the key order, so a key can only continue from one slice into
    # the next as the largest key of the one and the smallest of the other: fewer
    # such keys than slices.
    edges = ranged.groupBy("_slice").agg(F.min(F.struct(*key)).alias("lo"), F.max(F.struct(*key)).alias("hi"))
    ends = edges.select("_slice", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("k"))
    spanning = ends.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1")
    spanning = spanning.select(*[F.col("k")[k].alias("_" + k) for k in key])
    pieces = (
        ranged.join(F.broadcast(spanning), _same_key(ranged, spanning, key), "left_semi")
        .groupBy("_slice", *key)
        .agg(F.count("*").alias("_rows"))
    )
    before = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select(
        F.col("_slice").alias("_from_slice"),
        *[F.col(k).alias("_" + k) for k in key],
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_carried"),
    )
    match = _same_key(numbered, carried, key) & (numbered["_slice"] == carried["_from_slice"])
    joined = numbered.join(F.broadcast(carried), match, "left")
    number = F.col("_n") + F.coalesce(F.col("_carried"), F.lit(0))
    return joined.select(*[numbered[c] for c in rows.columns], number.cast("bigint").alias(name))
