"""The nightly build: landed raw tables to stored cubes, each stage a column file read by the next.

Stages are stored where several later jobs read them, so nothing is computed twice and a lost stage
can be rebuilt alone. Reports then start from the stored cubes.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.plans import catalogue, costs, margin, orders, users
from basketry.session import stage_table, use_settings
from basketry.sources import buckets, increments, readers, writers
from basketry.sources.manifest import Store


class Nightly:
    """Reads raw tables and sheets from `raw`, writes cubes under `out`."""

    def __init__(self, spark: SparkSession, raw: str, out: str, sheets: dict[str, DataFrame]):
        use_settings(spark)
        self.spark, self.raw, self.out, self.sheets = spark, raw, out.rstrip("/"), sheets

    def table(self, name: str) -> DataFrame:
        return readers.landed(self.spark, self.raw, name)

    def cube(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/{name}")

    def store(self, name: str, build: Callable[[], DataFrame], partition_by: list[str] | None = None) -> None:
        writers.store(build(), f"{self.out}/{name}", partition_by=partition_by)

    def build_cubes(self) -> list[str]:
        """UTM, item, order, first-buyer, user and product cubes. Needs the sheet `state_map`."""
        t, c = self.table, self.cube
        steps = {
            "utm_cube": lambda: users.utm_cube(t("utms")),
            "order_items_cube": lambda: orders.order_items_cube(t("order_items"), t("orders")),
            "authorized_orders": lambda: orders.authorized_orders(
                t("orders"), self.sheets["state_map"], t("utms"),
                orders.order_sums(t("order_items")),
            ),
            "first_time_buyers": lambda: orders.first_time_buyers(c("authorized_orders")),
            "monthly_buyer_type": lambda: orders.monthly_buyer_type(c("authorized_orders"), c("first_time_buyers")),
            "users_cube": lambda: users.users_buyer_flag(
                users.users_cube(t("users"), t("utms"), t("app_sessions")), c("first_time_buyers")
            ),
            "products_dimension": lambda: catalogue.products_dimension(t("products"), t("tags"), t("brands")),
        }
        for name, build in steps.items():
            self.store(name, build)
        return list(steps)

    def build_facts(self, as_of: dt.date, reduction: str) -> list[str]:
        """Administrative order facts up to first-order distances and expected revenue.

        Needs the sheets `status_names` and `status_lists`; the conversion history lives under `out`.
        """
        t, c = self.table, self.cube
        history_path = f"{self.out}/conversion_history"
        history_schema = (
            "unit string, day date, rate_1_30 double, rate_91_120 double, dif double, revenue decimal(38,4)"
        )
        self.store("orders_admin", lambda: orders.order_inclusion(
            orders.orders_admin(t("orders"), t("users"), self.sheets["status_names"], t("utms")),
            self.sheets["status_lists"],
        ))
        self.store("admin_items", lambda: orders.admin_items(t("order_items"), t("products"), t("categories")))
        self.store("customers_admin", lambda: users.customers_admin(t("users"), t("utms"), t("addresses")))
        self.store("orders_base", lambda: orders.orders_base(c("orders_admin"), reduction), ["month"])
        writers.upsert_snapshot(orders.conversion_snapshot(c("orders_base"), as_of), history_path, "day")
        history = writers.history_or_empty(self.spark, history_path, history_schema)
        self.store("order_cardinal", lambda: orders.order_cardinal(
            orders.conversion_estimate(c("orders_base"), history, as_of)
        ))
        self.store("customer_milestones", lambda: orders.customer_milestones(
            c("customers_admin"), c("order_cardinal")
        ))
        self.store("months_since_first", lambda: orders.months_since_first(
            c("order_cardinal"), c("customer_milestones")
        ))
        return ["orders_admin", "admin_items", "customers_admin", "orders_base", "order_cardinal", "customer_milestones",
                "months_since_first"]

    def store_buckets(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A cube in buckets of the order id. Its table is named after the output folder, so two builds do not meet."""
        mark = hashlib.sha256(self.out.encode()).hexdigest()[:12]
        return buckets.store_buckets(build(), f"{self.out}/{name}", f"{name}_{mark}", "order_id")

    def build_catalogue(self, since: dt.date) -> list[str]:
        """Campaigns and their products with size number and price band. Needs the sheets `campaign_reference` and `size_list`."""
        t, c, sheets = self.table, self.cube, self.sheets
        campaigns = lambda: catalogue.campaign_brand(t("campaigns"), t("campaigns_products"), t("products"), t("brands"))
        steps = {
            "campaign_catalogue": lambda: catalogue.campaign_catalogue(campaigns(), sheets["campaign_reference"], since),
            "campaign_products": lambda: catalogue.campaign_products(
                t("campaigns_products"), c("products_dimension"), c("campaign_catalogue")
            ),
            "size_order": lambda: catalogue.size_order(sheets["size_list"], c("campaign_products")),
            "price_bands": lambda: catalogue.price_bands(c("campaign_products"), c("campaign_catalogue")),
            "campaign_products_classified": lambda: catalogue.classified_products(
                c("campaign_products"), c("size_order"), c("price_bands"), c("campaign_catalogue")
            ),
            "campaign_items": lambda: catalogue.campaign_items(
                c("orders_admin"), c("admin_items"), c("campaign_catalogue"), c("campaign_products")
            ),
        }
        for name, build in steps.items():
            self.store(name, build)
        return list(steps)

    def build_margin(self, series_units: dict[int, str]) -> list[str]:
        """The costed order fact. Needs the ERP and carrier sheets and the monthly cost sheets of `costs.order_margin`.

        Tables by order id are stored in its buckets, so the fact joins them as they lie. Stored product costs win; this run's are
        frozen by `update_cost_history` afterwards.
        """
        t, c, sheets = self.table, self.cube, self.sheets
        methods = t("orders").select(F.col("id").alias("order_id"), "payment_method")
        heads = self.store_buckets("order_heads", lambda: margin.with_payment_form(c("orders_base"), methods))
        item_costs = margin.item_cost(heads, c("admin_items"), sheets["erp_products"], sheets["erp_stock"], t("order_items"))
        tables = {
            "order_item_costs": lambda: costs.product_costs(item_costs),
            "order_cost_history": lambda: self.cost_history(),
            "order_fraud": lambda: costs.order_fraud_fees(heads, sheets["fraud_by_order"]),
            "order_freight": lambda: costs.order_freight(heads, sheets["erp_invoices"], sheets["carrier"], series_units),
        }
        stored = [self.store_buckets(name, build) for name, build in tables.items()]
        self.store("order_margin", lambda: costs.order_margin(heads, *stored, sheets), ["month"])
        return ["order_heads", *tables, "order_margin"]

    def update_cost_history(self, costed: DataFrame) -> int:
        """Freeze last month's product costs; returns the number of runs that are published.

        Only orders without a stored cost are appended, as one run that becomes visible when it is complete. So a repeated run
        adds nothing, a broken one leaves nothing, and the stored history is read but never rewritten.
        """
        store = self.cost_store()
        fresh = stage_table(margin.unfrozen_costs(costed, self.cost_history()))
        if not fresh.isEmpty():
            store.publish({"data": store.write(fresh)})
        return len(store.entries())

    def cost_store(self) -> Store:
        return Store(self.spark, f"{self.out}/cost_history")

    def cost_history(self) -> DataFrame:
        return self.cost_store().read("order_id long, product_cost decimal(18,4)")

    def merge_raw(self, table: str, incoming: DataFrame) -> list[int]:
        """New and changed rows of a raw table with an id and `updated_at`, merged into its landed key ranges."""
        return increments.merge_into(incoming, f"{self.out}/merged/{table}", ["id"], "updated_at", increments.id_range("id"))
