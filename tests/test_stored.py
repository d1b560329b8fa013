"""Bucketed orders, roll-ups, the monthly stream's table and the search index."""

import uuid

import pytest
from pyspark.sql import functions as F

from stockweave.operators import analytics as A
from stockweave.operators import catalog as C
from stockweave.operators import quality as Q
from stockweave.operators import rollups, search_index
from stockweave.plans import views as V
from stockweave.plans.sales import _catalog
from stockweave.sources import order_store
from stockweave.streaming import intake


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_joins_of_bucketed_orders_move_no_rows(spark, tmp_path, no_broadcast):
    """One order holds a third of the lines."""
    orders = spark.range(300).select(
        F.col("id"), F.lit("visitor").alias("source"), F.lit(200).cast("bigint").alias("total_minor"), F.lit("2026-01-01").alias("created_at")
    )
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 300).alias("order_id"),
        F.col("id").cast("int").alias("line_no"),
        F.lit(2).cast("bigint").alias("unit_price_minor"),
        F.lit(1).cast("bigint").alias("quantity"),
    )
    name, path = f"hot_{uuid.uuid4().hex}", str(tmp_path / "orders")
    order_store.store_orders(orders, rows, name, path, buckets=8)
    stored, lines = order_store.open_orders(spark, name)
    joined, sums = order_store.read_orders(stored, lines), Q.reconcile_totals(stored, lines)
    lost = Q.orphans(lines, stored.filter("id <> 7"), "order_id", "id")
    for frame in (joined, sums, lost):
        assert "Exchange" not in plan(frame) and "SortMergeJoin" in plan(frame) or "ShuffledHashJoin" in plan(frame)
    assert joined.count() == 6000 and lost.count() == rows.filter("order_id = 7").count() > 2000
    wanted = {r.order_id: r.n for r in rows.groupBy("order_id").agg((F.count("*") * 2).alias("n")).collect() if r.n != 200}
    assert {r.order_id: r.lines_minor for r in sums.collect()} == wanted
    # lines of an order stand together and in order
    order_store.register_orders(spark, stored.schema, lines.schema, name + "_again", path, buckets=8)
    again = order_store.read_orders(*order_store.open_orders(spark, name + "_again"))
    assert "Exchange" not in plan(again)
    seen = [(r.order_id, r.line_no) for r in again.collect()]
    places = [seen.index(x) for x in seen if x[0] == 7]
    assert places == list(range(places[0], places[0] + len(places))) and [n for o, n in seen if o == 7] == sorted(n for o, n in seen if o == 7)


def test_rollups_equal_the_recompute_and_read_only_their_batch(spark, tables, tmp_path):
    root, orders, items = str(tmp_path / "rollup"), V.orders(spark, tables), V.items(spark, tables, snapshot=True)
    catalog = _catalog(spark, tables)
    for batch in range(3):
        path = str(tmp_path / f"in{batch}")
        orders.filter(F.col("id") % 3 == batch).write.parquet(f"{path}/orders")
        items.filter(F.col("order_id") % 3 == batch).write.parquet(f"{path}/items")
        new = spark.read.parquet(f"{path}/orders"), spark.read.parquet(f"{path}/items")
        read = rollups.rollup(*new).inputFiles()
        assert read and all(f"/in{batch}/" in f for f in read)
        rollups.add_batch(batch, *new, root)
        rollups.add_batch(batch, *new, root)
        if batch == 1:
            assert rollups.compact(spark, root) == 1
            assert not [f for f in rollups._current(spark, root).inputFiles() if f.endswith("batch_id=0")]
    for source in ("all", "visitor"):
        found = rollups.dashboard(spark, root, catalog, source)
        wanted = A.analytics_table(orders, items, catalog, source)
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_rollups_without_batches(spark, tables, tmp_path):
    catalog = _catalog(spark, tables)
    none = rollups.dashboard(spark, str(tmp_path / "none"), catalog)
    wanted = A.analytics_table(V.orders(spark, tables).filter("false"), V.items(spark, tables, snapshot=True).filter("false"), catalog)
    assert sorted(map(str, none.collect())) == sorted(map(str, wanted.collect()))
    assert rollups.compact(spark, str(tmp_path / "none")) is None


def test_a_monthly_batch_writes_only_what_it_changed(spark, tmp_path):
    source, root, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "created_at string, source string, revenue_minor bigint, units bigint"
    run = lambda: intake.stream_monthly(spark.readStream.schema(schema).parquet(source), root, mark).awaitTermination()
    add = lambda *rows: spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)
    now = lambda: {(r.month, r.source): (r.orders, r.revenue_minor, r.units) for r in intake.current_monthly(spark, root).collect()}
    add(("2026-04-03", "visitor", 10, 1), ("2026-05-03", "visitor", 20, 2), ("2026-05-03", "synthetic", 1, 1))
    run()
    add(("2026-04-01", "visitor", 5, 1))
    run()
    written = lambda batch: [(r.month, r.source, r.orders) for r in spark.read.parquet(f"{root}/batch_id={batch}").collect()]
    assert len(written(0)) == 3 and written(1) == [("2026-04", "visitor", 2)]
    wanted = {("2026-04", "visitor"): (2, 15, 2), ("2026-05", "visitor"): (1, 20, 2), ("2026-05", "synthetic"): (1, 1, 1)}
    assert now() == wanted
    # the last batch again: its commit is lost, its rows are overwritten
    (tmp_path / "mark" / "commits" / "1").unlink()
    (tmp_path / "mark" / "commits" / ".1.crc").unlink(missing_ok=True)
    run()
    assert now() == wanted and written(1) == [("2026-04", "visitor", 2)]
    assert intake.compact_monthly(spark, root) == 1 and now() == wanted
    add(("2026-06-01", "visitor", 7, 1))
    run()
    assert now() == wanted | {("2026-06", "visitor"): (1, 7, 1)} and intake.compact_monthly(spark, root) == 2
    assert now() == wanted | {("2026-06", "visitor"): (1, 7, 1)}


def test_indexed_search_equals_the_scan(spark, tmp_path):
    rows = [(1, "Paper KITE 100%", None, "B_1", "s"), (2, None, "a kite", None, None), (3, "İstanbul lamp", "x", "y", "z"), (4, "ab", "", "kit", "e")]
    rows += [(5, "kit", "ite", "ki", "te"), (6, "aaaa", "AAAAA", None, None)]
    catalog = spark.createDataFrame(rows, "id long, name string, description string, brand string, source_store string")
    catalog = catalog.withColumns({"category": F.lit("kids"), "price_minor": F.lit(5).cast("bigint")})
    search_index.build_index(catalog, str(tmp_path / "index"), shards=8)
    index = search_index.read_index(spark, str(tmp_path / "index"), "bigint")
    for q in ("kite", "KITE", "%", "_", "0%", "100%", "B_1", "ki", "aaaaa", "aaa", "STANBUL", "i̇stanbul", "nothing", "", " kite "):
        found = search_index.search_indexed(catalog, index, q=q, shards=8)
        assert {r.id for r in found.collect()} == {r.id for r in C.search_catalog(catalog, q=q).collect()}, q
    text = plan(search_index.candidates(index, "kite", shards=8))
    assert "PartitionFilters: [shard" in text and "PushedFilters: [In(gram, [ite,kit])" in text.replace("IsNotNull(gram), ", "")


def test_rollup_of_a_batch_ends_in_more_than_one_task(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame

    from stockweave.operators import rollups
    from stockweave.streaming import intake

    asked = []
    coalesce = DataFrame.coalesce
    monkeypatch.setattr(type(spark.range(1)), "coalesce", lambda rows, n: asked.append(n) or coalesce(rows, n))
    orders = spark.createDataFrame(
        [(1, "visitor", 30, "2026-04-01"), (2, "synthetic", None, "2026-05-01"), (3, "visitor", 5, "2026-05-02")],
        "id long, source string, total_minor long, created_at string")
    items = spark.createDataFrame(
        [(1, 7, "b", "men", 10, 1), (1, 7, "a", "men", 10, 2), (2, 7, "c", "women", 4, 1), (2, 8, None, None, None, 3), (9, 8, "x", "men", 1, 1)],
        "order_id long, product_id long, product_name string, category string, unit_price_minor long, quantity long")
    root = str(tmp_path / "rollup")
    rollups.add_batch(0, orders, items, root)
    rollups.compact(spark, root)
    found = {(r.part, r.entry, r.source): (r.orders, r.units, r.revenue_minor, r.name, r.category)
             for r in rollups.read_rollup(spark, root).collect()}
    assert found[("products", "7", "visitor")] == (0, 3, 30, "b", "men")
    assert found[("products", "7", "synthetic")] == (0, 1, 4, "c", "women")
    assert found[("products", "8", "synthetic")] == (0, 3, 0, None, None)
    assert found[("categories", "men", "visitor")] == (0, 3, 30, None, None)
    assert found[("categories", None, "synthetic")] == (0, 3, 0, None, None)
    assert found[("months", "2026-05", "synthetic")] == (1, 4, 4, None, None)
    assert len(found) == 10
    changed = spark.createDataFrame([("2026-04", "visitor", 1, 2, 3)], "month string, source string, orders long, revenue_minor long, units long")
    changed.write.parquet(f"{root}/monthly/batch_id=0")
    assert intake.compact_monthly(spark, f"{root}/monthly") == 0
    assert asked == []


def test_postings_of_a_catalog_in_one_split_are_made_on_all_cores(spark, monkeypatch):
    from stockweave.plans import stored

    parts = []
    build = search_index.build_index
    monkeypatch.setattr(search_index, "build_index", lambda rows, path: parts.append(rows.rdd.getNumPartitions()) or build(rows, path))
    catalog = spark.createDataFrame([(1, "Blue cap"), (2, "Red cap"), (3, None)], "id long, name string").coalesce(1)
    index = stored._index(spark, catalog)
    assert parts == [spark.sparkContext.defaultParallelism]
    assert {r.id for r in search_index.candidates(index, "CAP").collect()} == {1, 2}
    assert {r.id for r in search_index.candidates(index, "blue").collect()} == {1}
