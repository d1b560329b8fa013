"""Product feeds, page and image evidence, and the ledger of active imports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from stockweave.operators.ranking import rank_rows, sums_before
from stockweave.schemas import LEDGER


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON documents with their file; one document is one record."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("doc")
    )


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Feed documents `{products: [...]}` as rows (pos, item); items stay VARIANT.

    `pos` counts on from document to document, in the order of their paths. Wrong JSON types
    inside an item are findings, not read errors. A feed too large for documents comes
    as lines, see `read_feed_lines`.
    """
    products = F.try_variant_get("doc", "$.products", "array<variant>")
    documents = _documents(spark, path).select("file", products.alias("products"))
    if not documents.filter(F.col("products").isNull()).isEmpty():
        raise ValueError("source JSON must contain a products array")
    # a number per document: what comes before it
    sizes = documents.select(F.col("file").alias("_file"), F.size("products").cast("bigint").alias("n"))
    starts = sums_before(sizes, [F.col("_file").asc()], "n", "start")
    items = documents.select("file", F.posexplode("products").alias("at", "item"))
    placed = items.join(starts, F.col("file") == F.col("_file"))
    return placed.select((F.col("start") + F.col("at")).cast("bigint").alias("pos"), "item")


def feed_checked_on(spark: SparkSession, path: str) -> DataFrame:
    """The day each document was checked."""
    checked_on = F.try_variant_get("doc", "$.catalog_metadata.checked_on", "string")
    return _documents(spark, path).select(checked_on.alias("checked_on"))


def read_feed_lines(spark: SparkSession, path: str) -> DataFrame:
    """One item per line, any number of splittable files; `pos` follows file and line order."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_record"),
        "value",
    )
    lines = lines.filter(F.trim("value") != "")
    placed = rank_rows(lines, [F.col("_file").asc(), F.col("_block").asc(), F.col("_record").asc()], "pos")
    return placed.select((F.col("pos") - 1).alias("pos"), F.try_parse_json("value").alias("item"))


def latest_per_key(rows: DataFrame, key: str, order: Column | str) -> DataFrame:
    """The last row of each key; partial results are combined before the shuffle."""
    columns = rows.columns
    last = rows.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("_last"))
    return last.select(*[F.col("_last")[c].alias(c) for c in columns])


def read_evidence(spark: SparkSession, path: str, key: str, schema: StructType, lines: bool = False) -> DataFrame:
    """Evidence, one row per key; the last one in the order of paths and places wins.

    From documents `{checks: [...]}`, or, where evidence grows with the feed, from one check per line.
    """
    at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    if lines:
        checks = spark.read.schema(schema).json(path).select(at.alias("pos"), *schema.fieldNames())
    else:
        documents = spark.read.schema(StructType([StructField("checks", ArrayType(schema))])).json(path, multiLine=True)
        checks = documents.select(at.alias("file"), F.posexplode("checks").alias("n", "check"))
        checks = checks.select(F.struct("file", "n").alias("pos"), "check.*")
    return latest_per_key(checks, key, "pos").drop("pos")


def write_ledger(ledger: DataFrame, path: str) -> None:
    """One product per line, sorted by id."""
    ledger.orderBy("id").write.mode("errorifexists").json(path)


def read_ledger(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Active imports, from one document or from lines; a ledger that was never written is empty."""
    try:
        if lines:
            return spark.read.schema(LEDGER).json(path)
        document = spark.read.schema(StructType([StructField("products", ArrayType(LEDGER))])).json(
            path, multiLine=True
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)
    return document.select(F.explode("products").alias("p")).select("p.*")
