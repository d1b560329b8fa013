"""Raw catalog CSV in, cleaned catalog out."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stockweave.schemas import RAW_COLUMNS

# a field of a header line, with the comma before it
_FIELD = r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'


def _fields(line: Column) -> Column:
    def plain(field: Column) -> Column:
        quoted = F.replace(F.substr(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))
        return F.when(field.startswith('"'), quoted).otherwise(field)

    return F.transform(F.regexp_extract_all(F.ltrim(line, F.lit("\ufeff")), F.lit(_FIELD), F.lit(1)), plain)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """input_file and its column names as written, for every file: the CSV reader would rename duplicates."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("input_file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
        "value",
    )
    return lines.groupBy("input_file").agg(_fields(F.min_by("value", "at")).alias("names"))


def _header_problem(required: tuple[str, ...]) -> Column:
    missing = F.array_sort(F.array_except(F.array(*[F.lit(c) for c in required]), F.col("names")))
    return F.when(F.size(missing) > 0, F.concat(F.lit("missing columns: "), F.array_join(missing, ", "))).when(
        F.size(F.array_distinct("names")) < F.size("names"), F.lit("duplicate CSV column names")
    )


def header_issues(
    spark: SparkSession, path: str, required: tuple[str, ...] = RAW_COLUMNS, headers: DataFrame | None = None
) -> DataFrame:
    """A problem per file that has one: it rejects the whole file. `headers` as `read_headers` gave them, where they are known."""
    headers = read_headers(spark, path) if headers is None else headers
    checked = headers.withColumn("error", _header_problem(required)).filter("error IS NOT NULL")
    return checked.select(F.lit(1).cast("bigint").alias("row"), F.lit("").alias("id"), "error", "input_file")


def read_catalog_csv(spark: SparkSession, path: str, headers: DataFrame | None = None) -> DataFrame:
    """All columns as text, by name, with `row` (record number, header is 1), `ragged` and `input_file`.

    Files whose headers agree are read together, each kind of header with its own order of
    columns; files that `header_issues` reports are left out. Quoted line breaks are
    allowed, so one file is one task; a large catalog comes as many files. `headers` as in `header_issues`.
    """
    headers = read_headers(spark, path) if headers is None else headers
    sound = headers.filter(_header_problem(RAW_COLUMNS).isNull())
    # the driver lists the files anyway; kinds of headers are few
    kinds = sound.groupBy("names").agg(F.sort_array(F.collect_list("input_file")).alias("files")).collect()
    nothing = StructType([StructField(n, StringType()) for n in RAW_COLUMNS])
    empty = spark.createDataFrame([], nothing).selectExpr("*", "false AS ragged", "'' AS input_file", "0L AS row")
    parts = [_read_kind(spark, list(k.names), [unquote(f) for f in k.files]) for k in kinds]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts, empty)


def _read_kind(spark: SparkSession, names: list[str], files: list[str]) -> DataFrame:
    schema = StructType([StructField(n, StringType()) for n in names] + [StructField("_bad", StringType())])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad")
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
        .csv(files)
    )
    placed = rows.select(
        *[F.coalesce(F.col(f"`{n}`"), F.when(F.col("_bad").isNull(), F.lit(""))).alias(n) for n in names],
        F.col("_bad").isNotNull().alias("ragged"),
        F.col("_metadata.file_path").alias("input_file"),
        F.monotonically_increasing_id().alias("_at"),
    )
    # a file is read by one task without a break: its record number is the distance to its first
    first = placed.groupBy("input_file").agg(F.min("_at").alias("_first"))
    numbered = placed.join(first, "input_file").withColumn("row", F.col("_at") - F.col("_first") + 2)
    return numbered.drop("_at", "_first")


def count_records(spark: SparkSession, path: str) -> DataFrame:
    """Records below the header, whatever the columns are."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return rows.agg(F.count("*").alias("input_rows"))


def image_listing(spark: SparkSession, directory: str) -> DataFrame:
    """File names directly inside an image folder, without reading the files."""
    listed = spark.read.format("binaryFile").load(directory).select("path")
    return listed.select(F.substring_index("path", "/", -1).alias("name"))


def catalog_text(products: DataFrame) -> DataFrame:
    """The catalog as CSV shows it: lists as JSON text, the flag as 0 or 1, sorted by id."""
    return products.orderBy("id").withColumns(
        {"sizes": F.to_json("sizes"), "colors": F.to_json("colors"), "featured": F.col("featured").cast("int")}
    )


def write_clean_catalog(products: DataFrame, path: str) -> None:
    """Parquet with real lists, and CSV, both sorted by id."""
    products.orderBy("id").write.mode("errorifexists").parquet(f"{path}/parquet")
    catalog_text(products).write.mode("errorifexists").option("header", True).option("escape", '"').option(
        "emptyValue", ""
    ).csv(f"{path}/csv")
