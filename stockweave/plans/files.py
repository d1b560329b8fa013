"""Readers, writers and the publishing gate, over raw files written from the part table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stockweave.operators import cleaning as L
from stockweave.plans.cleaning import _CLEAN_SQL, _INNER_SQL, _RAW_SQL, raw_parts
from stockweave.schemas import LEDGER, RAW_COLUMNS, _struct
from stockweave.session import scratch_path
from stockweave.sources import catalog_csv, feeds, sinks
from stockweave.sources.tables import load_table

# the columns of file number n of three start at another place
_TURNS = (0, 3, 7)


def _csv_files(spark, d) -> str:
    """Three files with the columns in different orders."""
    root = scratch_path(spark, "csv")
    rows = raw_parts(spark, d).withColumn("_n", F.col("row") % 3)
    for n, turn in enumerate(_TURNS):
        own = rows.filter(F.col("_n") == n).select(*RAW_COLUMNS[turn:], *RAW_COLUMNS[:turn])
        kept = {"escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        own.coalesce(1).write.options(header=True, **kept).csv(f"{root}/{n}")
    return f"{root}/*"


def csv_read(spark, d):
    rows = catalog_csv.read_catalog_csv(spark, _csv_files(spark, d))
    return rows.groupBy("ragged", *RAW_COLUMNS).agg(F.count("*").alias("rows")).drop("alt", "image")


def csv_row_numbers(spark, d):
    """Numbers 2 to n + 1 in each file."""
    rows = catalog_csv.read_catalog_csv(spark, _csv_files(spark, d)).groupBy("input_file")
    numbered = rows.agg(
        F.count("*").alias("rows"), F.countDistinct("row").alias("numbers"), F.min("row").alias("first"), F.max("row").alias("last")
    )
    return numbered.drop("input_file")


def csv_header_issues(spark, d):
    """A sound file, one without `alt`, one that names `id` twice, each with all parts."""
    root = scratch_path(spark, "csv")
    bare = tuple(c for c in RAW_COLUMNS if c != "alt")
    for n, names in enumerate((RAW_COLUMNS, bare, (*RAW_COLUMNS, "id"))):
        head = spark.range(1).select(F.lit(",".join(names)).alias("line"))
        body = load_table(spark, d, "part").select(F.concat_ws(",", F.col("p_partkey").cast("string"), "p_name").alias("line"))
        head.unionByName(body).coalesce(1).write.text(f"{root}/{n}")
    found = catalog_csv.header_issues(spark, f"{root}/*")
    return found.select("row", "id", "error")


def _documents(rows, root: str, field: str) -> str:
    """JSON documents of up to 500 entries each, one file per document; rows have doc, n and entry (JSON text)."""
    entries = F.transform(F.array_sort(F.collect_list(F.struct("n", "entry"))), lambda e: e["entry"])
    text = F.concat(F.lit(f'{{"catalog_metadata":{{"checked_on":"2026-01-02"}},"{field}":['), F.array_join(entries, ","), F.lit("]}"))
    docs = rows.groupBy("doc").agg(text.alias("value"))
    docs.repartition("doc").write.partitionBy("doc").text(root)
    return root


def _parts(spark, d):
    return load_table(spark, d, "part").select(
        F.floor(F.col("p_partkey") / 500).alias("doc"), F.col("p_partkey").alias("n"), "p_partkey", "p_name", "p_size"
    )


def feed_read(spark, d):
    entry = F.to_json(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title")))
    path = _documents(_parts(spark, d).withColumn("entry", entry), scratch_path(spark, "feed"), "products")
    items = feeds.read_feed(spark, path)
    return items.select(
        "pos",
        F.try_variant_get("item", "$.id", "bigint").alias("id"),
        F.try_variant_get("item", "$.title", "string").alias("title"),
    )


_CHECK = _struct(("id", StringType()), ("status", StringType()))


def _checks(spark, d):
    entry = F.to_json(F.struct(F.concat(F.lit("size-"), F.col("p_size").cast("string")).alias("id"), F.col("p_name").alias("status")))
    return _parts(spark, d).withColumn("entry", entry)


def evidence_read(spark, d):
    path = _documents(_checks(spark, d), scratch_path(spark, "evidence"), "checks")
    return feeds.read_evidence(spark, path, "id", _CHECK)


def evidence_read_lines(spark, d):
    root = scratch_path(spark, "evidence")
    rows = _checks(spark, d).repartitionByRange(4, "n").sortWithinPartitions("n")
    rows.select("entry").write.text(root)
    return feeds.read_evidence(spark, root, "id", _CHECK, lines=True)


def ledger_read(spark, d):
    root = scratch_path(spark, "ledger")
    known = {"id": F.col("p_partkey").cast("string"), "name": F.col("p_name"), "image_urls": F.array("p_name"), "price_minor": F.col("p_size")}
    part = load_table(spark, d, "part")
    rows = part.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER.fields])
    feeds.write_ledger(rows, root)
    return feeds.read_ledger(spark, root, lines=True).select(
        "id", "name", F.col("price_minor").cast("bigint").alias("price_minor"), F.array_join("image_urls", "|").alias("image_urls")
    )


def publish_gate(spark, d):
    """A run that passes is published; the next one fails and leaves it in place."""
    root = scratch_path(spark, "published")
    names = load_table(spark, d, "part").select(F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(".webp")).alias("name"))
    raw = raw_parts(spark, d)
    accepted = L.clean_catalog(raw, names).accepted.select("id")
    sound = raw.join(accepted, F.lower(F.trim(raw["id"])) == accepted["id"], "left_semi")
    for rows in (sound, raw):
        clean = L.clean_catalog(rows, names)
        sinks.publish_if_passed({"catalog": clean.accepted}, clean.summary, {"issues": L.issue_log(clean)}, root)
    return sinks.read_published(spark, root, "catalog").select("id", "name", "price_minor").withColumn(
        "version", F.lit(sinks.latest_version(spark, root)).cast("bigint")
    )


QUERIES = {
    "csv_read": csv_read,
    "csv_row_numbers": csv_row_numbers,
    "csv_header_issues": csv_header_issues,
    "feed_read": feed_read,
    "evidence_read": evidence_read,
    "evidence_read_lines": evidence_read_lines,
    "ledger_read": ledger_read,
    "publish_gate": publish_gate,
}

_KEPT = ", ".join(c for c in RAW_COLUMNS if c not in ("alt", "image"))

ORACLE = {
    "csv_read": f"""SELECT false AS ragged, {_KEPT}, count(*) AS rows
        FROM (SELECT {_RAW_SQL} FROM ({_INNER_SQL}) u) r GROUP BY {_KEPT}, alt, image""",
    "csv_row_numbers": """SELECT count(*) AS rows, count(*) AS numbers, CAST(2 AS BIGINT) AS first, count(*) + 1 AS last
        FROM part GROUP BY (p_partkey + 2) % 3""",
    "csv_header_issues": """SELECT CAST(1 AS BIGINT) AS "row", '' AS id, error
        FROM (VALUES ('missing columns: alt'), ('duplicate CSV column names')) t(error)""",
    "feed_read": """SELECT row_number() OVER (ORDER BY CAST(p_partkey // 500 AS VARCHAR), p_partkey) - 1 AS pos,
        p_partkey AS id, p_name AS title FROM part""",
    "evidence_read": """SELECT 'size-' || CAST(p_size AS VARCHAR) AS id, p_name AS status FROM part
        QUALIFY row_number() OVER (PARTITION BY p_size ORDER BY CAST(p_partkey // 500 AS VARCHAR) DESC, p_partkey DESC) = 1""",
    "evidence_read_lines": """SELECT 'size-' || CAST(p_size AS VARCHAR) AS id, p_name AS status FROM part
        QUALIFY row_number() OVER (PARTITION BY p_size ORDER BY p_partkey DESC) = 1""",
    "ledger_read": """SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, CAST(p_size AS BIGINT) AS price_minor,
        p_name AS image_urls FROM part""",
    "publish_gate": _CLEAN_SQL + """SELECT id, name, amount AS price_minor, CAST(1 AS BIGINT) AS version
        FROM e WHERE len(problems) = 0""",
}
