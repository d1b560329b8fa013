"""What several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.session import settle_table, tune

# a word is a maximal run of characters other than space, \t, \n, \v, \f and \r
SPACE_CLASS = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE_CLASS}]+"


# rows that a Python task holds at once
BATCH_ROWS = 1_000


def tuned(spark: SparkSession) -> SparkSession:
    """The library's settings, and small batches for Python, as texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return tune(spark)


def fresh(rows: DataFrame, name: str) -> str:
    """`name`, with underscores in front until `rows` has no such column."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(rows: DataFrame, name: str, label: str) -> DataFrame:
    """`rows` with a unique number per row, written once so that a task run again sees the same numbers."""
    return settle_table(rows.withColumn(name, F.monotonically_increasing_id()), label)


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))
