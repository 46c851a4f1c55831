"""The registered queries: every job wired to the shop tables of a test folder."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.plans import catalogue as cat
from basketry.plans import costs as cst
from basketry.plans import lifecycle as life
from basketry.plans import margin as mar
from basketry.plans import orders as ords
from basketry.plans import service as svc
from basketry.plans import users as usr
from basketry.session import shared_folder, stage_table
from basketry.sources import buckets, readers, writers
from basketry.sources.schemas import WEB_EVENTS
from checks.bindings import DELIVERY_LABELS, INVENTORY_LABELS, Shop
from checks.columns import COLUMNS, EXPORTS, shown

AS_OF = dt.date(2001, 7, 31)
MAIL_AS_OF = dt.date(2024, 1, 31)
SINCE = dt.date(1995, 1, 1)
KIND_CUTOFF = dt.date(1998, 6, 1)
PERIOD = (dt.date(1997, 8, 1), dt.date(1998, 10, 31))
REDUCTION = "0.02"
SPEND_MONTHS = {dt.date(2001, 5, 1): "m_2001_05", dt.date(2001, 6, 1): "m_2001_06", dt.date(2001, 7, 1): "m_2001_07"}
SERIES_UNITS = {0: "main", 1: "second"}


def job(build):
    """A property that builds its frame once, and stages it when the running query asks for that."""
    name = build.__name__

    def get(self):
        if name not in self.frames:
            frame = build(self)
            self.frames[name] = stage_table(frame) if name in self.staged else frame
        return self.frames[name]

    return property(get)


class Jobs:
    """Lazy frames; each property is one job on the frames it needs.

    `staged` names the intermediate frames to write out because the query reads them several times.
    """

    def __init__(self, spark: SparkSession, folder: str, staged: tuple[str, ...] = ()):
        self.spark, self.shop, self.staged, self.frames = spark, Shop(spark, folder), staged, {}

    # ---- channels and users
    @job
    def source_groups(self):
        return usr.source_groups(self.shop.utms)

    @job
    def utm_cube(self):
        return usr.utm_cube(self.shop.utms)

    @job
    def users_cube(self):
        return usr.users_cube(self.shop.users, self.shop.utms, self.shop.app_sessions)

    @job
    def users_buyer_flag(self):
        return usr.users_buyer_flag(self.users_cube, self.first_time_buyers)

    @job
    def non_buyers(self):
        return usr.non_buyers(self.users_buyer_flag)

    @job
    def vip_cohorts(self):
        return usr.vip_cohorts(self.shop.users)

    @job
    def users_with_address(self):
        return usr.users_with_address(self.shop.users, self.shop.addresses)

    @job
    def users_main_address(self):
        return usr.users_main_address(self.shop.users, self.shop.addresses)

    @job
    def customers_admin(self):
        return usr.customers_admin(self.shop.users, self.shop.utms, self.shop.addresses)

    @job
    def customer_source(self):
        return usr.customer_source(self.customers_admin, self.shop.web_events)

    @job
    def customers_states(self):
        return usr.customers_states(self.customers_admin, self.orders_base, self.shop.br_states)

    # ---- orders
    @job
    def order_items_cube(self):
        return ords.order_items_cube(self.shop.items, self.shop.orders)

    @job
    def order_items_plain(self):
        return ords.order_items_plain(self.shop.items)

    @job
    def order_totals(self):
        return ords.order_totals(self.order_items_cube)

    @job
    def order_totals_by_state(self):
        return ords.order_totals_by_state(self.shop.items, self.shop.orders)

    @job
    def authorized_orders(self):
        sums = ords.order_sums(self.shop.items)
        return ords.authorized_orders(self.shop.orders, self.shop.state_map, self.shop.utms, sums)

    @job
    def orders_treated(self):
        return ords.orders_treated(self.shop.orders, self.shop.users, self.shop.state_map)

    @job
    def first_time_buyers(self):
        return ords.first_time_buyers(self.authorized_orders)

    @job
    def orders_is_ftb(self):
        return ords.orders_is_ftb(self.authorized_orders, self.first_time_buyers)

    @job
    def monthly_buyer_type(self):
        return ords.monthly_buyer_type(self.authorized_orders, self.first_time_buyers)

    @job
    def treated_first_buyers(self):
        return ords.first_time_buyers(self.orders_treated.where("consider = 'yes'"), "created_on")

    @job
    def ftb_report_users(self):
        return ords.ftb_report_users(self.treated_first_buyers, self.shop.users, self.vip_cohorts)

    @job
    def ftb_report_orders(self):
        return ords.ftb_report_orders(self.orders_treated, self.shop.lifetime_vip, self.treated_first_buyers)

    @job
    def first_order_of_user(self):
        return ords.first_order_of_user(self.shop.orders)

    @job
    def order_newest_version(self):
        changed = self.shop.orders.where("state = 'pending'").withColumns({
            "state": F.lit("captured"), "updated_at": F.timestamp_add("DAY", F.lit(1), "updated_at"),
        })
        return ords.order_newest_version(self.shop.orders, changed)

    @job
    def orders_admin(self):
        return ords.orders_admin(self.shop.orders, self.shop.users, self.shop.status_names, self.shop.utms)

    @job
    def order_inclusion(self):
        return ords.order_inclusion(self.orders_admin, self.shop.status_lists)

    @job
    def admin_items(self):
        return ords.admin_items(self.shop.items, self.shop.products, self.shop.categories)

    @job
    def orders_base(self):
        unit = F.when(F.col("order_id") % 3 == 0, "second").otherwise("main")
        orders = ords.orders_admin(self.shop.orders, None, self.shop.status_names, self.shop.utms)
        return ords.orders_base(orders, REDUCTION, unit)

    @job
    def order_cardinal(self):
        return ords.order_cardinal(self.orders_base)

    @job
    def order_cardinal_expected(self):
        return ords.order_cardinal(self.conversion_estimate)

    @job
    def customer_milestones(self):
        return ords.customer_milestones(self.customer_source, self.order_cardinal)

    @job
    def months_since_first(self):
        return ords.months_since_first(self.order_cardinal, self.customer_milestones)

    @job
    def conversion_snapshot(self):
        return ords.conversion_snapshot(self.orders_base, AS_OF)

    @job
    def conversion_history(self):
        return ords.conversion_history(self.shop.conversion_history, self.conversion_snapshot, AS_OF)

    @job
    def conversion_estimate(self):
        return ords.conversion_estimate(self.orders_base, self.conversion_history, AS_OF)

    @job
    def adhoc_monthly_totals(self):
        return ords.monthly_totals(self.shop.orders, *PERIOD)

    @job
    def adhoc_daily_sales(self):
        return ords.daily_sales(self.shop.orders, *PERIOD)

    @job
    def adhoc_registrations(self):
        return ords.monthly_registrations(self.shop.users)

    @job
    def adhoc_final_items(self):
        return ords.final_items(self.shop.orders, self.shop.items, *PERIOD)

    @job
    def adhoc_orders_by_utm(self):
        return ords.orders_by_utm(self.shop.orders, self.shop.utms, *PERIOD)

    @job
    def adhoc_distinct_products(self):
        return ords.monthly_distinct_products(self.shop.orders, self.shop.items, PERIOD[0])

    @job
    def adhoc_users_with_utm(self):
        return ords.users_with_utm(self.shop.users, self.shop.utms, *PERIOD)

    # ---- catalogue
    @job
    def products_dimension(self):
        return cat.products_dimension(self.shop.products, self.shop.tags, self.shop.brands)

    @job
    def sku_category(self):
        return cat.sku_category(self.shop.products, self.shop.category_table)

    @job
    def product_image(self):
        return cat.product_image(self.shop.products)

    @job
    def campaigns_dimension(self):
        return cat.campaigns_dimension(self.shop.campaigns, INVENTORY_LABELS, DELIVERY_LABELS)

    @job
    def campaign_stock(self):
        return cat.campaign_stock(self.campaigns_dimension, self.shop.campaigns_products)

    @job
    def active_campaign_products(self):
        return cat.active_campaign_products(self.shop.campaigns, self.shop.campaigns_products)

    @job
    def active_campaigns_monthly(self):
        return cat.active_campaigns_monthly(self.shop.campaigns)

    @job
    def product_revenue_items(self):
        return cat.product_revenue_items(self.shop.orders, self.shop.items, self.shop.state_map)

    @job
    def revenue_by_campaign(self):
        return cat.revenue_by_campaign(self.shop.orders, self.shop.items, self.shop.campaigns, self.shop.state_map)

    @job
    def campaign_product_list(self):
        return cat.campaign_product_list(self.shop.items, self.shop.orders, self.shop.campaigns, self.shop.products)

    @job
    def campaign_product_month_to_date(self):
        return cat.campaign_product_month_to_date(self.campaign_product_list, AS_OF)

    @job
    def campaign_brand(self):
        shop = self.shop
        return cat.campaign_brand(shop.campaigns, shop.campaigns_products, shop.products, shop.brands)

    @job
    def campaign_catalogue(self):
        return cat.campaign_catalogue(self.campaign_brand, self.shop.campaign_reference, SINCE)

    @job
    def campaign_export_flag(self):
        every = cat.campaign_catalogue(
            self.campaign_brand, self.shop.campaign_reference, SINCE, drop_not_available=False
        )
        return cat.campaign_export_flag(every, self.shop.skip_list, self.shop.orders)

    @job
    def campaigns_without_reference(self):
        return cat.campaigns_without_reference(self.campaign_brand, self.shop.campaign_reference, self.shop.orders)

    @job
    def campaign_products(self):
        return cat.campaign_products(self.shop.campaigns_products, self.products_dimension, self.campaign_catalogue)

    @job
    def size_order(self):
        return cat.size_order(self.shop.size_list, self.campaign_products)

    @job
    def campaign_kind_gender(self):
        return cat.campaign_kind_gender(self.campaign_catalogue, self.campaign_products, KIND_CUTOFF)

    @job
    def price_bands(self):
        return cat.price_bands(self.campaign_products, self.campaign_catalogue)

    @job
    def campaign_products_classified(self):
        return cat.classified_products(self.campaign_products, self.size_order, self.price_bands, self.campaign_catalogue)

    @job
    def campaign_items(self):
        return cat.campaign_items(
            self.order_inclusion, self.admin_items, self.campaign_catalogue, self.campaign_products
        )

    @job
    def campaign_day(self):
        return cat.campaign_day(
            self.order_inclusion, self.admin_items, self.campaign_catalogue, self.campaign_products
        )

    @job
    def campaign_orders(self):
        return cat.campaign_orders(
            self.order_inclusion, self.admin_items, self.campaign_catalogue, self.campaign_products
        )

    # ---- margin
    @job
    def order_attribution(self):
        return mar.order_attribution(self.orders_base, self.shop.web_transactions)

    @job
    def channel_counts(self):
        return mar.channel_counts(self.orders_admin, self.shop.web_transactions, self.customer_source)

    @job
    def channel_rules(self):
        return mar.channel_rules(self.channel_counts, self.shop.rules)

    @job
    def untreated_channels(self):
        return mar.untreated_channels(self.channel_counts, self.shop.rules)

    @job
    def channel_orders(self):
        shop_term = self.orders_base.select("order_id", "utm_term", "utm_gclid")
        attributed = self.order_attribution.drop("utm_term", "utm_gclid").join(shop_term, "order_id", "left")
        return mar.channel_apply(attributed, self.channel_rules, "order_")

    @job
    def channel_customers(self):
        return mar.channel_apply(self.customer_source, self.channel_rules, "customer_")

    @job
    def shipping_adjust(self):
        return mar.shipping_adjust(self.orders_base, self.shop.shipping_factors)

    @job
    def item_cost(self):
        return mar.item_cost(self.orders_base, self.admin_items, self.shop.erp_products, self.shop.erp_stock, self.shop.items)

    @job
    def frozen_order_cost(self):
        return mar.frozen_order_cost(self.shipping_adjust, self.item_cost, self.shop.cost_history)

    @job
    def new_cost_history(self):
        return mar.new_cost_history(self.frozen_order_cost, self.shop.cost_history)

    @job
    def taxes(self):
        return mar.taxes(self.frozen_order_cost, self.shop.tax_rates)

    @job
    def base_by_payment_method(self):
        methods = self.shop.orders.select(F.col("id").alias("order_id"), "payment_method")
        return mar.with_payment_form(self.orders_base, methods)

    @job
    def payment_fee(self):
        return mar.payment_fee(self.base_by_payment_method, self.shop.payment_fees)

    @job
    def fraud_and_gateway(self):
        shop = self.shop
        return mar.fraud_and_gateway(
            self.base_by_payment_method, shop.fraud_by_order, shop.fraud_by_month, shop.gateway_by_month
        )

    @job
    def packaging_share(self):
        return mar.packaging_share(self.orders_base, self.shop.packaging_by_month)

    @job
    def fulfilment_share(self):
        return mar.fulfilment_share(self.orders_base, self.shop.fulfilment_by_month, self.shop.production_by_month)

    @job
    def real_freight(self):
        return mar.real_freight(self.shipping_adjust, self.shop.erp_invoices, self.shop.carrier, SERIES_UNITS)

    # The order margin starts from tables in buckets of the order id, written once.
    def bucketed(self, name: str, frame: DataFrame) -> DataFrame:
        path = self.path(name)
        return buckets.store_buckets(frame, path, path.rsplit("/", 1)[1].replace("-", "_"), "order_id")

    @job
    def order_margin(self):
        shop = self.shop
        heads = self.bucketed("heads", self.base_by_payment_method)
        costs = mar.item_cost(cst.recent_heads(heads), self.admin_items, shop.erp_products, shop.erp_stock, shop.items)
        return cst.order_margin(
            heads, self.bucketed("costs", cst.product_costs(costs)), self.bucketed("history", shop.cost_history.drop("month")),
            self.bucketed("fraud", cst.order_fraud_fees(heads, shop.fraud_by_order)),
            self.bucketed("freight", cst.order_freight(heads, shop.erp_invoices, shop.carrier, SERIES_UNITS)),
            {name: getattr(shop, name) for name in (
                "shipping_factors", "tax_rates", "payment_fees", "fraud_by_month", "gateway_by_month", "packaging_by_month",
                "fulfilment_by_month", "production_by_month", "margin_by_month")},
        )

    @job
    def invoices(self):
        return mar.invoices(self.shop.invoice_lines)

    @job
    def export_orders(self):
        return mar.export_orders(self.orders_admin)

    @job
    def export_items(self):
        return mar.export_items(self.admin_items, self.shop.campaigns)

    @job
    def export_users(self):
        return mar.export_users(self.customers_admin)

    # ---- service
    @job
    def delivery_dates(self):
        plain = ords.order_totals(self.order_items_plain)
        return svc.delivery_dates(self.shop.orders, self.shop.transition_logs, plain)

    @job
    def risk_rules(self):
        return svc.risk_rules(self.shop.risk_results, self.shop.orders, self.first_time_buyers)

    @job
    def risk_final_list(self):
        return svc.risk_final_list(self.risk_rules)

    @job
    def nps_groups(self):
        return svc.nps_groups(self.shop.survey, MAIL_AS_OF)

    @job
    def credits(self):
        return svc.credits(self.shop.credits)

    @job
    def orders_with_coupon(self):
        return svc.orders_with_coupon(self.shop.orders, self.shop.coupons, self.shop.state_map)

    @job
    def sales_metrics(self):
        return svc.sales_metrics(self.shop.items, ["campaign_id"])

    # ---- lifecycle
    @job
    def ltv_curve(self):
        return life.ltv_curve(self.months_since_first, self.customer_milestones)

    @job
    def ltv_summary(self):
        return life.ltv_summary(self.ltv_curve)

    @job
    def contribution_margin(self):
        return life.contribution_margin(self.orders_base, self.shop.margin_by_month)

    @job
    def email_send_summary(self):
        return life.email_send_summary(self.shop.sends, self.shop.visits, self.shop.mail_transactions)

    @job
    def email_engagement(self):
        return life.email_engagement(self.customer_milestones, self.shop.unsubscribes, self.shop.opens, MAIL_AS_OF)

    @job
    def marketing_spend(self):
        shop = self.shop
        return life.marketing_spend(
            shop.spend_by_month, shop.spend_split, shop.spend_allocation, SPEND_MONTHS, ("main", "second")
        )

    @job
    def acquisition_cost(self):
        return life.acquisition_cost(self.marketing_spend)

    @job
    def paid_orders(self):
        return self.orders_base.where("payment_confirmed = 1")

    @job
    def rfm_score(self):
        return life.rfm_score(self.paid_orders)

    @job
    def optin_active(self):
        return life.optin_active(self.email_engagement, self.paid_orders, AS_OF)

    @job
    def scored_customers(self):
        scores = self.rfm_score.drop("revenue_total")
        return self.optin_active.join(scores, "customer_id", "left")

    @job
    def days_since_previous_order(self):
        return life.days_since_previous_order(self.order_cardinal, self.customer_milestones)

    @job
    def client_segments(self):
        return life.client_segments(self.scored_customers)

    @job
    def churn_customers(self):
        levels = self.channel_customers.select("customer_id", "level1", "level2", "level3")
        return self.optin_active.join(levels, "customer_id", "left")

    @job
    def churn_snapshot(self):
        return life.churn_snapshot(self.churn_customers, AS_OF)

    @job
    def rfm_export(self):
        levels = self.channel_customers.select("customer_id", "level1", "level2")
        return life.rfm_export(self.scored_customers.join(levels, "customer_id", "left"))

    @job
    def orders_cardinal_export(self):
        fields = self.order_attribution.select("order_id", "order_source", "order_medium", "order_campaign")
        numbered = self.days_since_previous_order.join(fields, "order_id", "left")
        return life.orders_cardinal_export(numbered, self.customer_milestones)


    # ---- sources and sinks, through files in the shared folder
    def path(self, name: str) -> str:
        return f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"

    @job
    def landed_orders(self):
        """Store the raw orders, read a column subset back with a filter that reaches the scan."""
        folder = self.path("raw")
        writers.store(self.shop.orders, f"{folder}/orders")
        columns = ["id", "user_id", "state", "cached_total_value", "created_at"]
        landed = readers.landed(self.spark, folder, "orders", columns)
        return landed.where(F.col("state").isin("delivered", "captured")).withColumn(
            "created_on", F.to_date("created_at"))

    @job
    def invoices_from_files(self):
        """Invoice lines written as many delimited files and read back by one glob."""
        folder = self.path("invoices")
        lines = self.shop.invoice_lines
        writers.export(lines.repartition(4), folder, sep=";")
        schema = ", ".join(f"{c} string" for c in lines.columns)
        return mar.invoices(readers.delimited(self.spark, f"{folder}/part-*.csv", schema, sep=";"))

    @job
    def web_events_from_files(self):
        """Headerless web-analytics files, columns by position, days as YYYYMMDD."""
        folder = self.path("events")
        events = self.shop.web_events
        events.select(
            F.date_format("date", "yyyyMMdd"), "source", "medium", "campaign", "customer_id", "event_id"
        ).write.csv(folder)
        return readers.web_dates(readers.positional(self.spark, folder, WEB_EVENTS))

    @job
    def conversion_snapshot_stored(self):
        """Earlier snapshots, then the run day's twice: its partition is replaced, the others stay."""
        path = self.path("conversion")
        writers.upsert_snapshot(self.shop.conversion_history, path, "day")
        today = ords.conversion_snapshot(self.orders_base, AS_OF)
        writers.upsert_snapshot(today.withColumn("revenue", F.lit(0).cast("decimal(38,4)")), path, "day")
        return writers.upsert_snapshot(today, path, "day")

    @job
    def churn_snapshot_stored(self):
        """Two dated snapshots side by side."""
        path = self.path("churn")
        for day in (AS_OF - dt.timedelta(days=1), AS_OF):
            stored = writers.dated_snapshot(
                life.churn_snapshot(self.churn_customers, day).drop("churn_date"), path, day, "churn_date"
            )
        return stored


# Frames that a query reads more than once.
STAGES: dict[str, tuple[str, ...]] = {
    # The catalogue is small but needs a pass over all campaign products.
    "price_bands": ("campaign_catalogue",),
    "campaign_products_classified": ("campaign_catalogue", "campaign_products"),
    "campaign_kind_gender": ("campaign_catalogue",),
    "campaign_items": ("campaign_catalogue",),
    "campaign_day": ("campaign_catalogue",),
    "campaign_orders": ("campaign_catalogue",),
    "months_since_first": ("orders_base", "order_cardinal"),
    "days_since_previous_order": ("orders_base", "order_cardinal"),
    "orders_cardinal_export": ("orders_base", "order_cardinal"),
    "conversion_estimate": ("orders_base",),
    "order_cardinal_expected": ("orders_base",),
    "frozen_order_cost": ("orders_base",),
    "new_cost_history": ("orders_base", "frozen_order_cost"),
    "taxes": ("orders_base",),
    "packaging_share": ("orders_base",),
    "fulfilment_share": ("orders_base",),
    "ltv_summary": ("orders_base", "order_cardinal", "customer_milestones"),
    "ltv_curve": ("orders_base", "order_cardinal", "customer_milestones"),
    "channel_orders": ("orders_base", "channel_counts"),
    "channel_customers": ("channel_counts",),
    "channel_rules": ("channel_counts",),
    "untreated_channels": ("channel_counts",),
    "rfm_export": ("orders_base", "channel_customers"),
    "churn_snapshot_stored": ("churn_customers",),
    "conversion_snapshot_stored": ("orders_base",),
}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return shown(getattr(Jobs(spark, folder, STAGES.get(name, ())), name), name)


def names() -> list[str]:
    return [*COLUMNS, *EXPORTS]
