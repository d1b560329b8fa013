"""Plans: what is pushed down, split, limited and never used."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from stockweave.operators import analytics as A
from stockweave.operators import catalog as C
from stockweave.operators import quality as Q
from stockweave.plans import registry
from stockweave.plans import views as V
from stockweave.plans.sales import _catalog
from stockweave.session import tune

# not planned here, by name
SLOW = {
    "publish_gate": "runs the whole clean job several times and returns its report",
    "stream_orders_batches": "runs the stream of stream_orders several times",
    # the rows of feed_results, reduced
    "import_summary": "imports the feed of feed_results again",
    "failure_breakdown": "imports the feed of feed_results again",
    "ledger_merge": "imports the feed of feed_results again",
    "retire_records": "imports the feed of feed_results again",
}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    changed = {}

    def put(**settings):
        for key, value in settings.items():
            name = key.replace("__", ".")
            changed[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield put
    for name, value in changed.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def test_no_query_joins_all_pairs_or_runs_python(spark, tables):
    assert SLOW.keys() <= registry.queries().keys()
    for name, query in registry.queries().items():
        if name in SLOW:
            continue
        text = plan(query(spark, tables))
        for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
            assert unwanted not in text, (name, unwanted)


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 5


def hot(spark):
    """Orders and lines of which one order holds a third."""
    orders = spark.range(3000).select(
        "id", F.lit("visitor").alias("source"), F.lit(1).cast("bigint").alias("total_minor"),
        F.lit("2026-01-01").alias("created_at"))
    items = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 3000).alias("order_id"),
        (F.col("id") % 100).alias("product_id"), F.lit("men").alias("category"), F.lit("n").alias("product_name"),
        F.lit(2).cast("bigint").alias("unit_price_minor"), F.lit(1).cast("bigint").alias("quantity"))
    return orders, items.repartition(8)


@pytest.fixture
def skewed(spark, conf):
    tune(spark)
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="8KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__optimizer__runtime__bloomFilter__enabled="false",
        spark__sql__shuffle__partitions="16",
    )
    return hot(spark)


def test_hot_order_is_split_in_line_joins(skewed):
    orders, items = skewed
    sales = A.category_sales(orders, items)
    assert [(r.units, r.revenue_minor) for r in sales.collect()] == [(60000, 120000)]
    assert "skew=true" in plan(sales)
    lost = Q.orphans(items, orders.filter("id <> 7"), "order_id", "id")
    assert len(lost.collect()) == items.filter("order_id = 7").count()
    assert "skew=true" in plan(lost)


def test_hot_order_is_summed_before_header_joins(skewed):
    orders, items = skewed
    monthly = A.monthly_sales(orders, items)
    assert [(r.units, r.revenue_minor) for r in monthly.collect()] == [(60000, 120000)]
    logical = monthly._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join Inner.*Aggregate \[order_id", logical, re.S)


def test_top_of_a_category_is_cut_before_the_shuffle(spark, tables):
    catalog = _catalog(spark, tables)
    text = plan(C.related_products(catalog))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "TakeOrderedAndProject" in plan(C.top_k(catalog, C.sort_order("featured"), 4))


def test_filters_and_columns_reach_the_scan(spark, tables):
    text = plan(C.search_catalog(V.source_products(spark, tables).select("id", "brand", "category"), "men"))
    assert re.search(r"ReadSchema: struct<p_partkey:bigint,p_brand:string,p_type:string>", text)
    assert "In(p_brand" in text
    summary = plan(A.source_counts(V.orders(spark, tables)))
    assert "ReadSchema: struct<o_orderstatus:string>" in summary


def test_equal_rows_of_one_group_are_numbered_once(spark):
    from stockweave.operators.ranking import number_within, rank_rows

    rows = spark.range(5000).select(F.lit(1).alias("order_id"), F.lit("p").alias("product_id"))
    numbered = number_within(rows, ["order_id"], [F.col("product_id")])
    assert sorted(r.line_no for r in numbered.collect()) == list(range(1, 5001))
    ranked = rank_rows(spark.range(5000).repartition(7), [F.col("id").desc()])
    assert all(r.position == 5000 - r.id for r in ranked.collect())


def test_sums_before_over_slices(spark):
    from stockweave.operators.ranking import sums_before

    rows = spark.range(500).repartition(7).select("id", (F.col("id") % 5).alias("n"))
    found = {r.id: r.start for r in sums_before(rows, [F.col("id").asc()], "n", "start").collect()}
    assert found == {i: sum(j % 5 for j in range(i)) for i in range(500)}
    assert sums_before(rows.limit(0), [F.col("id").asc()], "n", "start").count() == 0


def test_lines_unfolded_from_few_runs_are_not_broadcast(spark):
    from stockweave.operators.orders import synth_orders

    tune(spark)
    products = spark.range(5).select(
        F.format_string("p-%d", "id").alias("id"), F.lit("n").alias("name"), F.lit("men").alias("category"),
        F.lit("d").alias("description"), F.lit("a").alias("alt"), F.lit("i").alias("image"), F.lit(100).cast("bigint").alias("price_minor"),
        F.array(F.lit("S")).alias("sizes"), F.array(F.lit("red")).alias("colors"), F.lit(True).alias("featured"))
    months = spark.createDataFrame([(2026, 1, 9000)], "year int, month int, orders bigint")
    headers, lines = synth_orders(products, months)
    assert headers.count() == 9000
    assert len(lines.collect()) == 18000
    text = plan(lines)
    assert re.search(r"SortMergeJoin\(?.*\[_rank", text) and not re.search(r"BroadcastHashJoin \[_rank", text)
    # the runs of a month stay in as many parts as there are shuffle partitions
    assert "REPARTITION_BY_NUM" in text


def test_own_url_is_keyed_once(spark, conf):
    from stockweave.operators import feed as M
    from stockweave.operators import feed_rules as R
    from stockweave.schemas import IMAGE_EVIDENCE, PAGE_EVIDENCE

    conf(spark__sql__debug__maxToStringFields="1000")
    feed = spark.createDataFrame([(0, "{}")], "pos long, t string").select("pos", F.parse_json("t").alias("item"))
    none = [spark.createDataFrame([], schema) for schema in (PAGE_EVIDENCE, IMAGE_EVIDENCE)]
    rows = M.with_keys(R.validate_feed(R.key_feed(feed), *none))
    text = rows._jdf.queryExecution().analyzed().toString()
    # canonical URL, page and image evidence are keyed only where they are not the row's own URL
    assert len(re.findall(r"source_url#\d+\)* THEN source_key#\d+", text)) == 3


def test_image_evidence_broadcasts_no_growing_side(spark, tables):
    from stockweave.plans import imports

    assert "BroadcastHashJoin" not in plan(imports.image_evidence(spark, tables))


def test_steps_keep_several_tasks_a_core(spark):
    least = int(tune(spark).conf.get("spark.sql.adaptive.coalescePartitions.minPartitionNum"))
    assert least > 2 * spark.sparkContext.defaultParallelism
