"""Whole runs: clean a catalog file, import a feed, apply an import to the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.operators import feed as M
from stockweave.operators import maintain as U
from stockweave.operators import match_index
from stockweave.operators.cleaning import CleanCatalog, clean_catalog, issue_log
from stockweave.operators.orders import synth_orders
from stockweave.schemas import LEDGER
from stockweave.session import settle_table
from stockweave.sources import catalog_csv, sinks
from stockweave.sources.versions import KeyedStore

# Demo orders per month of 2026, April to September.
DEMO_YEAR = 2026
DEMO_MONTHS = {4: 4, 5: 5, 6: 6, 7: 6, 8: 7, 9: 8}


def demo_months(spark: SparkSession) -> DataFrame:
    rows = [(DEMO_YEAR, month, count) for month, count in DEMO_MONTHS.items()]
    return spark.createDataFrame(rows, "year int, month int, orders int")


def _report_header(spark: SparkSession, source: str, root: str, issues: DataFrame) -> None:
    rows = catalog_csv.count_records(spark, source)
    summary = rows.select(
        "input_rows",
        F.lit(0).cast("bigint").alias("accepted_rows"),
        F.col("input_rows").alias("rejected_rows"),
        F.lit("failed").alias("status"),
    )
    sinks.write_report({"summary": summary, "issues": issues}, f"{root}/report")


def _is_current(spark: SparkSession, outputs: dict[str, DataFrame], report: dict[str, DataFrame], root: str) -> bool:
    """Whether every published output and every part of the report equals what a run would write now."""
    if sinks.latest_version(spark, root) == 0:
        return False
    stored = [(rows, sinks.read_published(spark, root, name)) for name, rows in outputs.items()]
    stored += [(rows, sinks.read_report(spark, root, name, rows.schema)) for name, rows in report.items()]
    return all(sinks.drift(new, old).isEmpty() for new, old in stored)


def clean_job(spark: SparkSession, source: str, image_dir: str, root: str, check: bool = False) -> bool:
    """Clean `source` and publish catalog and demo orders under `root`.

    A file that fails leaves only its report; what was published before stays.
    With `check` nothing is published: TRUE when the report and all outputs are current.
    The source is read and evaluated once; every output starts from the evaluated rows.
    """
    headers = settle_table(catalog_csv.read_headers(spark, source), "headers")
    issues = catalog_csv.header_issues(spark, source, headers=headers)
    if not issues.isEmpty():
        if not check:
            _report_header(spark, source, root, issues)
        return False
    clean = clean_catalog(catalog_csv.read_catalog_csv(spark, source, headers), catalog_csv.image_listing(spark, image_dir))
    clean = CleanCatalog(settle_table(clean.evaluated, "clean"))
    if check and clean.summary.first()["status"] != "passed":
        return False
    report = {
        "issues": issue_log(clean),
        "normalizations": clean.normalizations,
        "category_counts": clean.category_counts,
    }
    orders, lines = synth_orders(clean.accepted, demo_months(spark))
    outputs = {"catalog": clean.accepted, "orders": orders, "order_items": lines}
    if check:
        return _is_current(spark, outputs, {"summary": clean.summary, **report}, root)
    texts = {"catalog_csv": catalog_csv.catalog_text(clean.accepted)}
    return sinks.publish_if_passed(outputs, clean.summary, report, root, texts)


def published_ledger(spark: SparkSession, root: str) -> DataFrame:
    if sinks.latest_version(spark, root) == 0:
        return spark.createDataFrame([], LEDGER)
    return sinks.read_published(spark, root, "ledger")


def follow_ledger(spark: SparkSession, index: KeyedStore, root: str) -> None:
    """Bring a match index to the last published ledger; ledgers that were missed come in as one difference."""
    while (now := sinks.latest_version(spark, root)) != (before := match_index.seen(index, "ledger")):
        old = sinks.read_published(spark, root, "ledger", before) if before else spark.createDataFrame([], LEDGER)
        try:
            match_index.follow(index, 1, old, sinks.read_published(spark, root, "ledger", now), ("ledger", before, now))
        except match_index.IndexMoved:
            continue


def import_job(
    spark: SparkSession,
    feed: DataFrame,
    pages: DataFrame,
    images: DataFrame,
    catalog: DataFrame,
    root: str,
    check: bool = False,
    checked_on: DataFrame | None = None,
    index: KeyedStore | None = None,
) -> bool:
    """Import a feed next to a clean `catalog`; the ledger under `root` is the state.

    Running it again changes nothing but the version and the report, which then calls the
    items existing. `checked_on` is the day of the source (`feeds.feed_checked_on`); the last
    of several goes into the report. With `check` nothing is published: TRUE when ledger,
    records and report are current. The feed is classified once. With an `index`
    (`match_index`, which the owner of the catalog keeps up to date for its rows) the feed is
    matched against the kept keys; the index follows the ledger before it is asked.
    """
    ledger = published_ledger(spark, root)
    if index is None:
        owners_of = lambda asked: M.base_keys(M.match_base(catalog, ledger))
    else:
        follow_ledger(spark, index, root)
        owners_of = match_index.owners_of(index)
    found = M.classify_feed_with(feed, pages, images, owners_of)
    found = M.FeedImport(settle_table(found.rows, "import"))
    merged = settle_table(U.merge_ledger(ledger, found.accepted, found.results), "ledger")
    retired = U.retire_records(found.results, merged)
    day = F.lit(None).cast("string") if checked_on is None else checked_on.agg(F.max("checked_on")).scalar()
    report = {
        "run": spark.range(1).select(F.lit("passed").alias("status"), day.alias("source_checked_on")),
        "summary": M.import_summary(found.results),
        "counts": U.import_counts(catalog, merged, retired),
        "failure_breakdown": M.failure_breakdown(found.results),
        "products": found.results,
    }
    outputs = {
        "ledger": merged.orderBy("id"),
        "retire_records": retired.select("pos", "product_id", "title", "source_url", "failure_reasons"),
    }
    if check:
        return _is_current(spark, outputs, report, root)
    sinks.write_report(report, f"{root}/report")
    sinks.publish(spark, outputs, root)
    return True


def apply_import(
    tables: dict[str, DataFrame], ledger: DataFrame, records: DataFrame, order_items: DataFrame, at
) -> dict[str, DataFrame]:
    """Activate the ledger, then retire the rejected rows; `tables` as `maintain.activate` returns them."""
    active = U.activate(
        tables["products"], tables["source_products"], tables["unavailable"], tables["retired"], ledger
    )
    return U.retire(
        active["products"],
        active["source_products"],
        active["unavailable"],
        active["retired"],
        order_items,
        U.latest_per_key(records.filter("product_id IS NOT NULL"), "product_id", "pos"),
        at,
    )
