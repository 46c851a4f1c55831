import datetime as dt
from decimal import Decimal

import pytest
from checks.bindings import Shop
from conftest import rows
from pyspark.sql import functions as F

from basketry.pipeline import Nightly
from basketry.plans import orders
from basketry.sources import schemas, writers
from basketry.sources.manifest import Store

FOLDER = "/root/testdata/sf0.001"
RAW = {
    "orders": "orders", "order_items": "items", "users": "users", "utms": "utms", "app_sessions": "app_sessions",
    "products": "products", "tags": "tags", "brands": "brands", "categories": "categories", "addresses": "addresses",
    "campaigns": "campaigns", "campaigns_products": "campaigns_products",
}


def landed(df, table, spark):
    schema = spark.createDataFrame([], schemas.TABLES[table]).schema
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])


def test_nightly_build(spark, tmp_path):
    shop, raw, out = Shop(spark, FOLDER), f"{tmp_path}/raw", f"{tmp_path}/out"
    for table, source in RAW.items():
        writers.store(landed(getattr(shop, source), table, spark), f"{raw}/{table}")
    sheets = {n: getattr(shop, n) for n in (
        "state_map", "status_names", "status_lists", "campaign_reference", "size_list", "erp_products", "erp_stock", "fraud_by_order",
        "erp_invoices", "carrier", "shipping_factors", "tax_rates", "payment_fees", "fraud_by_month", "gateway_by_month",
        "packaging_by_month", "fulfilment_by_month", "production_by_month", "margin_by_month")}
    night = Nightly(spark, raw, out, sheets)
    as_of = dt.date(2001, 7, 31)
    for name in night.build_cubes() + night.build_facts(as_of, "0.02"):
        assert night.cube(name).limit(1).count() == 1, name
    direct = orders.order_totals(orders.order_items_cube(shop.items, shop.orders))
    stored = night.cube("authorized_orders").where("final_order_value is not null")
    joined = stored.select("order_id", "final_order_value").join(
        direct.select("order_id", F.col("final_order_value").alias("v")), "order_id")
    assert joined.count() == stored.count() and joined.where("final_order_value <> v").count() == 0
    firsts = night.cube("order_cardinal").groupBy("customer_id").agg(F.sum("is_ftp").alias("n"))
    assert rows(firsts.select("n").distinct()) == [(1,)]
    assert "order_margin" in night.build_margin({0: "main", 1: "second"})
    costed, base = night.cube("order_margin"), night.cube("orders_base")
    assert costed.count() == base.count() and costed.where("abs(revenue - order_cost - margin) > 1e-6").count() == 0
    assert costed.where("product_cost > 0").count() > 0 and costed.where("packaging > 0").count() > 0
    night.update_cost_history(costed)
    assert night.build_margin({0: "main", 1: "second"}) and night.cube("order_margin").count() == base.count()
    for name in night.build_catalogue(dt.date(1995, 1, 1)):
        assert night.cube(name).limit(1).count() == 1, name
    classified = night.cube("campaign_products_classified")
    assert classified.where("size_sort is null and size is not null").count() == 0
    assert classified.where("band is null and final_price is not null and treated_slug is not null").count() == 0
    # a second run of the same day replaces that day's snapshot
    writers.upsert_snapshot(orders.conversion_snapshot(night.cube("orders_base"), as_of), f"{out}/conversion_history", "day")
    assert spark.read.parquet(f"{out}/conversion_history").count() == 1


def test_cost_history_keeps_what_it_has(spark, frame, tmp_path):
    night = Nightly(spark, "unused", str(tmp_path), {})
    schema = "order_id long, month date, product_cost decimal(18,4)"
    jan, feb, mar = dt.date(2015, 1, 1), dt.date(2015, 2, 1), dt.date(2015, 3, 1)

    def history():
        return [(o, float(c)) for o, c in rows(night.cost_history())]

    run1 = frame([(1, jan, Decimal(5)), (2, feb, Decimal(6))], schema)
    assert night.update_cost_history(run1) == 1 and history() == [(1, 5.0)]
    files = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet") if "cost_history" in str(p)}
    assert night.update_cost_history(run1) == 1 and night.update_cost_history(run1) == 1  # repeated runs add nothing
    run2 = frame([(1, jan, Decimal(9)), (2, feb, Decimal(7)), (3, mar, Decimal(8))], schema)
    publish, Store.publish = Store.publish, None  # a run that breaks before it is published
    try:
        with pytest.raises(TypeError):
            night.update_cost_history(run2)
    finally:
        Store.publish = publish
    assert history() == [(1, 5.0)]
    assert night.update_cost_history(run2) == 2 and history() == [(1, 5.0), (2, 7.0)]
    assert night.update_cost_history(run2) == 2 and history() == [(1, 5.0), (2, 7.0)]
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())  # what was stored is never rewritten


def test_raw_tables_are_merged_by_key_range(spark, frame, tmp_path):
    night = Nightly(spark, "unused", str(tmp_path), {})
    rows_of = lambda ids, day: frame([(i, f"s{day}", dt.datetime(2015, 1, day)) for i in ids], "id long, state string, updated_at timestamp")
    assert night.merge_raw("orders", rows_of([1, 2_000_001], 1)) == [0, 2]
    assert night.merge_raw("orders", rows_of([2_000_001, 2_000_002], 2)) == [2]
    merged = spark.read.parquet(f"{tmp_path}/merged/orders")
    assert rows(merged, "id", "state") == [(1, "s1"), (2_000_001, "s2"), (2_000_002, "s2")]
