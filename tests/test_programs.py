"""Whole programs on the small lake, against results worked out in plain Python."""

from collections import Counter

from pyspark.sql import functions as F

from tablewright.functions import parse_double, strict_double
from tablewright.operators import split_rejects, unmatched
from tablewright.plans import programs
from tablewright.plans.jobs import export_table
from tablewright.sources import read_keyed, read_table
from tablewright.streaming import read_loaded, reset_bookmark
from tests import fixtures
from tests.test_operators import tuples

ORDERS = [(c, float(t) if t else None, d, s) for c, t, d, s in fixtures.orders()]
CUSTOMERS = {c["customer_id"]: c for c in fixtures.customers()}


def test_map_filter_summarize(spark, lake):
    shipped, report = programs.map_filter_summarize(spark, f"{lake['root']}/nb")
    assert shipped == sum(o[3] == "shipped" for o in ORDERS)
    counts = Counter(o[3] for o in ORDERS)
    expected = [
        (s, n, round(sum(o[1] or 0 for o in ORDERS if o[3] == s), 2))
        for s, n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    ]
    assert [tuple(r) for r in report.collect()] == expected


def test_orders_to_table(spark, lake):
    programs.orders_to_table(spark, f"{lake['root']}/out")
    out = read_loaded(spark, "processed", "orders")
    assert out.dtypes == [("customer_id", "string"), ("order_total", "double"), ("status", "string"), ("order_date", "string")]
    assert tuples(out) == sorted(((c, t, s, d) for c, t, d, s in ORDERS), key=repr)
    assert spark.sql("SHOW PARTITIONS processed.orders").count() == len({o[2] for o in ORDERS})
    plan = out.filter("order_date = '2026-03-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan


def test_customers_to_tables(spark, lake):
    tables = programs.customers_to_tables(spark, f"{lake['root']}/out", key="customer_id")
    assert set(tables) == {"customers_root", "customers_contacts"}
    root = {r.customer_id: r for r in read_table(spark, "processed", "customers_root").collect()}
    assert len(root) == len(CUSTOMERS)
    for key, customer in CUSTOMERS.items():
        points = customer["loyalty_points"]
        assert root[key].loyalty_points == (None if points is None else str(points))
        assert (root[key].address_city, root[key].address_zip) == tuple(customer["address"].values())
        assert root[key].contacts_size == len(customer["contacts"])
    contacts = tuples(read_table(spark, "processed", "customers_contacts"))
    assert contacts == sorted(
        ((k, i, x["type"], x["value"]) for k, c in CUSTOMERS.items() for i, x in enumerate(c["contacts"])), key=repr
    )


def test_latest_orders_enriched_and_keyed(spark, lake):
    latest = {}
    for c, t, d, _ in ORDERS:
        best = latest.get(c)
        if best is None or (d, t if t is not None else -1) > (best[0], best[1] if best[1] is not None else -1):
            latest[c] = (d, t)
    expected = {c: (t, d, CUSTOMERS[c]["name"], CUSTOMERS[c]["address"]["city"]) for c, (d, t) in latest.items()}
    enriched = programs.latest_orders_enriched(spark)
    assert {r[0]: tuple(r)[1:] for r in enriched.collect()} == expected
    for _ in range(2):
        programs.latest_orders_to_keyed(spark, f"{lake['root']}/keyed")
    back = read_keyed(spark, "processed", "orders_enriched")
    assert all(t == "string" for _, t in back.dtypes)
    assert {r.customer_id for r in back.collect()} == set(latest) and back.count() == len(latest)
    customers = read_table(spark, "raw", "customers")
    assert tuples(unmatched(customers, back, "customer_id").select("customer_id")) == [(k,) for k in sorted(set(CUSTOMERS) - set(latest))]


def test_incremental_orders(spark, lake):
    root = lake["root"]

    def run():
        return programs.incremental_orders(spark, lake["orders"], f"{root}/inc", f"{root}/state", out_table="inc")

    assert (run(), run()) == (1, 0)
    fixtures.write_orders(lake["orders"], "orders_2.csv", fixtures.orders(22, 12))
    assert run() == 1
    loaded = read_loaded(spark, "processed", "inc")
    assert loaded.count() == 82
    reset_bookmark(spark, "orders_to_table", "source_orders", f"{root}/state")
    run()
    assert read_loaded(spark, "processed", "inc").count() == 164


def test_batch_and_incremental_loads_share_the_table(spark, lake):
    programs.orders_to_table(spark, f"{lake['root']}/out")
    n = read_loaded(spark, "processed", "orders").count()
    assert programs.incremental_orders(spark, lake["orders"], f"{lake['root']}/out", f"{lake['root']}/state") == 1
    programs.orders_to_table(spark, f"{lake['root']}/out")
    assert read_loaded(spark, "processed", "orders").count() == 3 * n


def test_diagnosed_orders(spark, lake):
    programs.diagnosed_orders(spark, f"{lake['root']}/diag")
    expected = []
    for _, total, _, status in fixtures.orders_bad():
        if status == "shipped":
            expected.append(None if total in ("n/a", "") else float(total) * 100.0)
    out = read_table(spark, "processed", "orders_diagnosed")
    assert sorted((r[0] for r in out.select("order_total_cents").collect()), key=repr) == sorted(expected, key=repr)
    _, rejects = split_rejects(read_table(spark, "raw", "orders_bad"), {"order total": parse_double})
    assert {r.reject_value for r in rejects.collect()} == {"n/a", "12d"}


def test_managed_orders(spark, lake):
    first = programs.orders_to_managed(spark, f"{lake['root']}/managed")
    second = programs.orders_to_managed(spark, f"{lake['root']}/managed")
    assert (first["rows"], second["rows"]) == (60, 120)
    assert second["files_after"] == 1 <= second["files_before"]


def test_counted_and_shown(spark, lake):
    orders = read_table(spark, "raw", "orders").withColumn("total", strict_double("order total"))
    assert programs.counted_and_shown(orders) == [60, sum((o[1] or 0) > 100 for o in ORDERS)]


def test_engagement_to_table(spark, lake):
    events = spark.range(100).select(
        (F.lit("2026-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).alias("at"),
        (F.col("id") % 7).alias("user_id"),
        F.when(F.col("id") % 2 == 0, "view").otherwise("add_to_cart").alias("event_type"),
        F.lit(1.0).alias("value"),
    )
    for _ in range(2):
        programs.engagement_to_table(
            spark, events, f"{lake['root']}/kpis", ts="at", interest=("add_to_cart", "add_to_carts")
        )
    rows = read_table(spark, "reporting", "daily_engagement_kpis").orderBy("event_date").collect()
    assert [(r.active_users, r.views, r.add_to_carts) for r in rows] == [(7, 12, 12)] * 4 + [(4, 2, 2)]


def test_export_one_table_twice_appends(spark, lake):
    for _ in range(2):
        export_table(spark, "raw", "customers", "processed", f"{lake['root']}/out")
    assert read_table(spark, "processed", "customers").count() == 2 * len(CUSTOMERS)


def test_service_log_to_catalog(spark, lake):
    levels = programs.service_log_to_catalog(spark, lake["serverlog"])
    assert tuples(levels) == [("ERROR", 2), ("INFO", 5), ("WARN", 2)]
    table = read_table(spark, "raw", "service_log")
    assert [t for _, t in table.dtypes] == ["string"] * 5 + ["double"]
    assert table.agg(F.sum("amount")).first()[0] == sum(float(f"{i}.5{i}") for i in range(9))


def test_clicks_from_records(spark, tmp_path):
    (tmp_path / "clicks").mkdir()
    (tmp_path / "clicks" / "a.json").write_text(
        '{"ts":"2026-01-01T10:00:00","event_type":"purchase","user":{"id":1},"item":{"price":1.5}}\n'
        '{"ts":"2026-01-01T11:00:00","event_type":"purchase","user":{"id":2},"item":{"price":"2.25"}}\n'
        '{"ts":"2026-01-01T12:00:00","event_type":"view","user":{"id":2},"item":{"price":"free"}}\n'
    )
    clicks = programs.clicks_from_records(spark, f"{tmp_path}/clicks")
    assert [t for _, t in clicks.dtypes] == ["timestamp_ntz", "bigint", "string", "double"]
    programs.engagement_to_table(spark, clicks, f"{tmp_path}/kpis", out_db="default")
    try:
        row = read_table(spark, "default", "daily_engagement_kpis").first()
        assert (row.active_users, row.purchases, row.views, row.revenue, row.conversion) == (2, 2, 1, 3.75, 2.0)
    finally:
        spark.sql("DROP TABLE default.daily_engagement_kpis")
