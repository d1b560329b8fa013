"""An index of character trigrams for literal text search.

The searched fields of a catalog, A-Z folded, give a posting (shard, gram, id, field) per distinct trigram of
a field. Postings lie in folders by shard, a hash of the gram, sorted by gram, so a search reads the
shards of its own trigrams and skips row groups without them. Rows in which one field has all trigrams of the
needle are candidates; the literal test decides. Needles below three characters have no trigram and scan
the catalog, like a search without index. Wildcards have no meaning; NULL fields have no postings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.functions.text import ascii_lower
from stockweave.operators.catalog import SEARCHED, search_catalog

GRAM = 3
SHARDS = 64
_SCHEMA = "gram string, id {kind}, field string, shard int"


def _shard(gram: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(shards)).cast("int")


def _grams(text: Column) -> Column:
    """Distinct trigrams of a text; none where it is shorter."""
    starts = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
    found = F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, F.lit(GRAM))))
    return F.when(F.length(text) >= GRAM, found).otherwise(F.array().cast("array<string>"))


def postings(catalog: DataFrame, shards: int = SHARDS) -> DataFrame:
    """gram, id, field and shard of every trigram of every searched field."""
    fields = [F.struct(F.lit(name).alias("field"), ascii_lower(name).alias("text")) for name in SEARCHED if name in catalog.columns]
    texts = catalog.select("id", F.inline(F.array(*fields))).filter(F.col("text").isNotNull())
    rows = texts.select("id", "field", F.explode(_grams(F.col("text"))).alias("gram"))
    return rows.select("gram", "id", "field", _shard(F.col("gram"), shards).alias("shard"))


def build_index(catalog: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the postings. A frequent gram may fill its shard: rows are dealt by gram and id, so several tasks write it."""
    rows = postings(catalog, shards).repartitionByRange("shard", "gram", "id").sortWithinPartitions("shard", "gram", "id")
    rows.write.partitionBy("shard").parquet(path)


def read_index(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The postings under `path`; `kind` is the type of the ids."""
    return spark.read.schema(_SCHEMA.format(kind=kind)).parquet(path)


def needle_grams(needle: str) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in needle)
    return sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})


def candidates(index: DataFrame, needle: str, shards: int = SHARDS) -> DataFrame:
    """Ids of rows in which a field has every trigram of `needle`."""
    grams = needle_grams(needle)
    spark = index.sparkSession
    listed = spark.range(1).select(F.explode(F.array(*map(F.lit, grams))).alias("gram"))
    wanted = [r["s"] for r in listed.select(_shard(F.col("gram"), shards).alias("s")).distinct().collect()]  # one per gram
    found = index.filter(F.col("shard").isin(wanted) & F.col("gram").isin(grams))
    # a field has a gram once, so plain counts will do; combined before the shuffle
    whole = found.groupBy("id", "field").agg(F.count("*").alias("n")).filter(F.col("n") == len(grams))
    return whole.select("id").distinct()


def search_indexed(
    catalog: DataFrame, index: DataFrame, category: str = "", q: str = "", min_price=None, max_price=None, shards: int = SHARDS
) -> DataFrame:
    """`catalog.search_catalog` through the index; the same rows."""
    found = search_catalog(catalog, category, q, min_price, max_price)
    needle = (q or "").strip()
    if len(needle) < GRAM:
        return found
    return found.join(candidates(index, needle, shards), "id", "left_semi")
