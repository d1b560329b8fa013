"""Reports, gated publishing into versions, and drift against a stored output.

Plain Parquet has neither MERGE nor overwrite-while-reading, so every output is
a new version, claimed once all its files are there (`versions`).
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stockweave.sources import versions


def write_report(parts: dict[str, DataFrame], path: str) -> None:
    for name, rows in parts.items():
        rows.write.mode("overwrite").json(f"{path}/{name}")


def read_report(spark: SparkSession, root: str, name: str, schema: StructType) -> DataFrame:
    """A part of the last report; empty where it was never written."""
    try:
        return spark.read.schema(schema).json(f"{root}/report/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def latest_version(spark: SparkSession, root: str) -> int:
    """Number of the last published version, 0 when there is none."""
    return versions.latest(spark, root)


def version_path(spark: SparkSession, root: str, version: int, name: str) -> str:
    return f"{root}/outputs/{versions.content(spark, root, version)['folder']}/{name}"


def read_published(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    version = latest_version(spark, root) if version is None else version
    if version == 0:
        raise FileNotFoundError(f"nothing published under {root}")
    return spark.read.parquet(version_path(spark, root, version, name))


def read_published_csv(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A CSV output of the last version, all columns as text."""
    path = version_path(spark, root, latest_version(spark, root), name)
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("emptyValue", "").csv(path)


def publish(spark: SparkSession, outputs: dict[str, DataFrame], root: str, texts: dict[str, DataFrame] | None = None) -> int:
    """Write the outputs, and `texts` as CSV, to a folder of their own, then claim the next version for it."""
    folder = uuid.uuid4().hex
    for name, rows in outputs.items():
        rows.write.parquet(f"{root}/outputs/{folder}/{name}")
    for name, rows in (texts or {}).items():
        rows.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(f"{root}/outputs/{folder}/{name}")
    return versions.publish_next(spark, root, {"folder": folder})


def publish_if_passed(
    outputs: dict[str, DataFrame],
    summary: DataFrame,
    report: dict[str, DataFrame],
    root: str,
    texts: dict[str, DataFrame] | None = None,
) -> bool:
    """Write the report always, the outputs only when the one-row summary passed."""
    write_report({"summary": summary, **report}, f"{root}/report")
    if summary.first()["status"] != "passed":
        return False
    publish(summary.sparkSession, outputs, root, texts)
    return True


def drift(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows, with copies, that only one side has; empty means the stored output is current.

    One aggregation over both sides instead of two EXCEPT ALLs.
    """
    columns = new.columns
    signed = new.withColumn("_n", F.lit(1)).unionByName(old.select(*columns).withColumn("_n", F.lit(-1)))
    balance = signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    return balance.select(
        *columns,
        F.when(F.col("_n") > 0, F.lit("missing")).otherwise(F.lit("stale")).alias("side"),
        F.abs("_n").alias("copies"),
    )


def drift_by_digest(store: versions.KeyedStore, name: str, new: DataFrame) -> DataFrame:
    """`drift` of `new` against a stored table; only buckets whose checksums differ are read and compared."""
    stale = store.stale_buckets(name, new)
    changed = new.filter(store.bucket(name).isin(*stale)) if stale else new.limit(0)
    return drift(changed, store.read(name, buckets=stale))
