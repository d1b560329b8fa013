import csv
import json
from pathlib import Path

from pyspark.sql import functions as F

from stockweave.operators import analytics as A
from stockweave.operators import quality as Q
from stockweave.operators.catalog import active_catalog
from stockweave.plans import jobs
from stockweave.schemas import IMAGE_EVIDENCE, PAGE_EVIDENCE, PRODUCT, PRODUCT_COLUMNS, RETIRED, UNAVAILABLE
from stockweave.sources import sinks
from tests.test_cleaning import FIELDS, raw
from tests.test_feed import evidence, feed_of, variant


def write(path, rows):
    with path.open("w", encoding="utf-8", newline="") as stream:
        writer = csv.DictWriter(stream, fieldnames=FIELDS)
        writer.writeheader()
        writer.writerows(rows)


def test_clean_job(spark, tmp_path):
    images, source, root = tmp_path / "images", tmp_path / "catalog.csv", str(tmp_path / "out")
    images.mkdir()
    (images / "one.webp").write_bytes(b"x")
    run = lambda check=False: jobs.clean_job(spark, str(source), str(images), root, check)
    write(source, [raw(i, price_inr=str(100 + i)) for i in range(7)])
    assert not run(check=True)
    assert run() and run(check=True)
    published = Path(sinks.version_path(spark, root, 1, "catalog")).parent.relative_to(root)
    for part in ("report/category_counts", f"{published}/order_items", f"{published}/catalog"):
        kept = {p: p.read_bytes() for p in (tmp_path / "out" / part).iterdir() if p.name.startswith("part-")}
        first = next(iter(kept))
        rows = spark.read.format("json" if "report" in part else "parquet").load(str(tmp_path / "out" / part))
        changed = str(tmp_path / "changed" / part)
        rows.limit(max(rows.count() - 1, 0)).write.format("json" if "report" in part else "parquet").save(changed)
        for p in kept:
            p.unlink()
        for p in (tmp_path / "changed" / part).iterdir():
            if p.name.startswith("part-"):
                first.with_name(p.name).write_bytes(p.read_bytes())
        assert not run(check=True), part
        for p in (tmp_path / "out" / part).iterdir():
            p.unlink()
        for p, content in kept.items():
            p.write_bytes(content)
    assert run(check=True)
    orders, lines = (sinks.read_published(spark, root, n) for n in ("orders", "order_items"))
    assert orders.count() == 36 and lines.count() == 74
    assert A.units_sold(orders, lines).collect()[0].units == 147
    assert Q.reconcile_totals(orders, lines).count() == 0
    months = {r.month: r.orders for r in A.monthly_sales(orders, lines).collect()}
    assert months == {"2026-04": 4, "2026-05": 5, "2026-06": 6, "2026-07": 6, "2026-08": 7, "2026-09": 8}
    write(source, [raw(price_inr="-1")])
    assert not run() and not run(check=True)
    assert sinks.read_published(spark, root, "catalog").count() == 7
    source.write_text("id,name\na,b\n")
    assert not run()
    summary = spark.read.json(f"{root}/report/summary").collect()[0]
    assert (summary.input_rows, summary.rejected_rows, summary.status) == (1, 1, "failed")


def test_import_job_is_idempotent_and_applies(spark, tmp_path):
    root = str(tmp_path / "imports")
    rows = [variant(1), variant(2), variant(3, {"price_inr": None})]
    items, pages, images = map(list, zip(*rows))
    catalog = spark.createDataFrame([], PRODUCT)
    inputs = (feed_of(spark, items), evidence(spark, pages, PAGE_EVIDENCE), evidence(spark, images, IMAGE_EVIDENCE))
    assert not jobs.import_job(spark, *inputs, catalog, root, check=True)
    jobs.import_job(spark, *inputs, catalog, root)
    first = sinks.read_published(spark, root, "ledger").collect()
    assert [r.id for r in first] == ["source-men-1", "source-men-2"]
    assert not jobs.import_job(spark, *inputs, catalog, root, check=True)  # the report still calls them added
    day = spark.createDataFrame([("2026-01-01",), ("2026-01-03",)], "checked_on string")
    jobs.import_job(spark, *inputs, catalog, root, checked_on=day)
    assert jobs.import_job(spark, *inputs, catalog, root, check=True, checked_on=day)
    assert not jobs.import_job(spark, *inputs, catalog, root, check=True)
    assert spark.read.json(f"{root}/report/run").collect()[0].asDict() == {"source_checked_on": "2026-01-03", "status": "passed"}
    assert sinks.read_published(spark, root, "ledger").collect() == first
    summary = json.loads((spark.read.json(f"{root}/report/summary").toJSON().collect())[0])
    assert (summary["already_existed"], summary["rejected"]) == (2, 1)
    ledger, records = (sinks.read_published(spark, root, n) for n in ("ledger", "retire_records"))
    old = ledger.select(*PRODUCT_COLUMNS).limit(1).withColumn("id", F.lit("source-men-3"))
    tables = {"products": old, "source_products": spark.createDataFrame([], PRODUCT),
              "unavailable": spark.createDataFrame([], UNAVAILABLE), "retired": spark.createDataFrame([], RETIRED)}
    sold = spark.createDataFrame([("source-men-3",)], "product_id string")
    for _ in range(2):
        tables = jobs.apply_import(tables, ledger, records, sold, "2026-01-01")
    assert sorted(r.id for r in tables["products"].collect()) == ["source-men-1", "source-men-2", "source-men-3"]
    assert [(r.id, r.reason) for r in tables["unavailable"].collect()] == [("source-men-3", "strict_import_rejected")]
    shown = active_catalog(tables["products"], tables["source_products"], tables["unavailable"], tables["retired"])
    assert sorted(r.id for r in shown.collect()) == ["source-men-1", "source-men-2"]
