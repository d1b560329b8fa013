"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def load_spread(spark: SparkSession, directory: str, name: str, *columns: str) -> DataFrame:
    """The columns of a table that is stored as one split, dealt to all cores.

    For tables known to be small files whose rows cost much work each; a layout of the
    reader, never of an operator.
    """
    rows = load_table(spark, directory, name)
    return (rows.select(*columns) if columns else rows).repartition(spark.sparkContext.defaultParallelism)


def load_tables(spark: SparkSession, directory: str, *names: str) -> dict[str, DataFrame]:
    return {name: load_table(spark, directory, name) for name in names}
