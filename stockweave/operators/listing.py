"""Sorted listings page by page from a clustered layout.

A listing is the catalog written once per sort order: by category, range partitioned and sorted on the keys of the order
(for prices: price, name, id), so that a file holds a short range of them. A small table of fences (category, file,
smallest and largest key, rows) goes with it. A page is asked for by the cursor of the row before it: the
fences tell which files hold the next rows, only these are read, and the top of them is the page. No
listing is sorted as a whole and no page counts the rows before it. Price bands and categories reach the files as
pushed filters and partitions. A hot category is as many files as it needs; equal keys end with the id.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stockweave.functions.text import ascii_lower
from stockweave.operators.catalog import search_catalog
from stockweave.operators.errors import RequestError
from stockweave.sources import versions

MAX_PAGE = 1000
_LAST = (1 << 63) - 1


def _keys(sort: str) -> list[Column]:
    """Keys without NULLs whose ascending order is the order of `catalog.sort_order`."""
    # a missing name comes before all others
    name = F.coalesce(F.concat(F.lit("="), ascii_lower("name")), F.lit(""))
    first = {
        "featured": F.when(F.col("featured").isNull(), 2).when(F.col("featured").cast("boolean"), 0).otherwise(1).cast("bigint"),
        "price_asc": F.coalesce(F.col("price_minor"), F.lit(_LAST)),
        "price_desc": F.coalesce(-F.col("price_minor"), F.lit(_LAST)),
        "name": F.lit(0).cast("bigint"),
    }
    if sort not in first:
        raise RequestError("Choose a valid product sort order.")
    return [first[sort].alias("_first"), name.alias("_name"), F.col("id").alias("_id")]


_KEY = ("_first", "_name", "_id")


def write_listing(catalog: DataFrame, root: str, sorts: tuple[str, ...] = ("featured", "price_asc", "price_desc", "name"), files: int = 64) -> int:
    """Write the layouts and their fences, then claim the next version; readers of the version before go on undisturbed.

    `files` per layout; choose it so that a file is some 128 MB.
    """
    spark, folder = catalog.sparkSession, uuid.uuid4().hex
    for sort in sorts:
        path = f"{root}/data/{folder}/{sort}"
        keyed = catalog.select("*", *_keys(sort)).repartitionByRange(files, "category", *_KEY)
        keyed.sortWithinPartitions("category", *_KEY).write.partitionBy("category").parquet(path)
        # fences come from what was written: a task that ran twice has changed nothing
        stored = spark.read.schema(keyed.schema).parquet(path)
        key = F.struct(*_KEY)
        fences = stored.groupBy("category", F.col("_metadata.file_path").alias("file")).agg(
            F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("rows")
        )
        # few enough rows for a file or two; sorted, so that categories are row groups
        fences.orderBy("category", "low").coalesce(1).write.parquet(f"{root}/data/{folder}/{sort}-fences")
    schema = catalog.schema.jsonValue()
    return versions.publish_next(spark, root, {"folder": folder, "schema": schema, "sorts": list(sorts)})


class Listing:
    """A published listing; `spark` and `root` as it was written, the last version unless another is named."""

    def __init__(self, spark: SparkSession, root: str, version: int | None = None) -> None:
        version = versions.latest(spark, root) if version is None else version
        if not version:
            raise FileNotFoundError(f"nothing published under {root}")
        what = versions.content(spark, root, version)
        self.spark, self.folder, self.sorts = spark, f"{root}/data/{what['folder']}", what["sorts"]
        self.schema = StructType.fromJson(what["schema"])
        ids = self.schema["id"].dataType
        keys = [StructField("_first", LongType()), StructField("_name", StringType()), StructField("_id", ids)]
        self._stored = StructType([*self.schema.fields, *keys])

    def _layout(self, sort: str) -> str:
        if sort not in self.sorts:
            raise RequestError("Choose a valid product sort order.")
        return f"{self.folder}/{sort}"

    def band(self, category: str = "", q: str = "", min_price=None, max_price=None) -> DataFrame:
        """All rows of a search, from the price layout: the band skips files and row groups."""
        rows = self.spark.read.schema(self._stored).parquet(self._layout("price_asc"))
        return search_catalog(rows, category, q, min_price, max_price).select(*self.schema.names)

    def _fences(self, sort: str, category: str, after: list | None, min_price, max_price) -> DataFrame:
        fences = self.spark.read.parquet(f"{self._layout(sort)}-fences")
        wanted = (category or "").strip().lower()
        if wanted and wanted != "all":
            fences = fences.filter(F.col("category") == wanted)
        if after:
            fences = fences.filter(F.col("high") > _literal(after, fences.schema["high"].dataType))
        low, high = (int(v) if v not in (None, "") else None for v in (min_price, max_price))
        if sort == "price_desc":
            low, high = (None if high is None else -high), (None if low is None else -low)
        if sort.startswith("price"):
            fences = fences if low is None else fences.filter(F.col("high._first") >= low)
            fences = fences if high is None else fences.filter(F.col("low._first") <= high)
        return fences

    def page(
        self, sort: str = "featured", size: int = 24, after: str | None = None, category: str = "", q: str = "", min_price=None, max_price=None
    ) -> DataFrame:
        """The next `size` rows of a search in their order, each with its `cursor`; `after` is the cursor of the last row seen.

        A step reads the files that hold the next `size` rows of every category, and takes rows below the first key
        of the files it left out. Where a filter leaves too few of them, the next step reads twice as many; rows that
        were read already are read again, a constant factor.
        """
        if not 1 <= size <= MAX_PAGE:
            raise RequestError(f"A page has 1 to {MAX_PAGE} products.")
        seen = _parse(after) if after else None
        empty = self.spark.createDataFrame([], self._stored)
        search_catalog(empty, category, q, min_price, max_price)  # refuses wrong arguments
        fences = self._fences(sort, category, seen, min_price, max_price)
        kind = StructType(self._stored.fields[-len(_KEY):])
        key, wanted = F.struct(*_KEY), size
        while True:
            files, bound = self.files(fences, wanted)
            rows = self.spark.read.schema(self._stored).option("basePath", self._layout(sort)).parquet(*files) if files else empty
            if seen:
                rows = rows.filter((F.col("_first") >= F.lit(seen[0])) & (key > _literal(seen, kind)))
            if bound is not None:
                # a file that is left out may hold any row from here on
                rows = rows.filter(key < _literal(bound, kind))
            found = search_catalog(rows, category, q, min_price, max_price).orderBy(*_KEY).limit(size)
            if bound is None or found.count() == size:
                cursor = F.to_json(F.array(F.col("_first").cast("string"), "_name", F.col("_id").cast("string")))
                return found.select(*self.schema.names, cursor.alias("cursor"))
            wanted *= 2

    def files(self, fences: DataFrame, rows: int) -> tuple[list[str], tuple | None]:
        """The first files of every category that hold `rows` rows past the cursor, and the smallest key of the others, if any.

        A file holds a row at least, and the first one may end at once past the cursor: rows + 2 fences of a category
        are enough, and all the driver holds. Categories are few.
        """
        chosen, bounds = [], []
        for name in [r["category"] for r in fences.select("category").distinct().collect()]:
            first = fences.filter(F.col("category").eqNullSafe(F.lit(name))).orderBy("low").select("file", "rows", "low").limit(rows + 2).collect()
            held = 0
            for at, fence in enumerate(first):
                if held >= rows:
                    bounds.append(tuple(fence["low"]))
                    break
                chosen.append(unquote(fence["file"]))
                # the file with the cursor counts for nothing: its rows may lie before it
                held += fence["rows"] if at else 0
        return chosen, min(bounds, default=None)


def _parse(cursor: str) -> list:
    try:
        first, name, last = json.loads(cursor)
        return [int(first), str(name), last]
    except (TypeError, ValueError) as error:
        raise RequestError("The cursor is not one of a page.") from error


def _literal(key: list, kind: StructType) -> Column:
    return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(key, kind.fields)])
