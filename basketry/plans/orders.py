"""Orders, order items and first-time buyers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import (
    calendar_months_between, days_before, local_between, local_date, local_since, month_label, month_start,
)
from basketry.functions.numbers import flag, null_sum, ratio, total
from basketry.functions.text import differs, recode
from basketry.operators.grouping import first_by, merge_latest
from basketry.operators.joins import has_key, lookup, natural_left
from basketry.operators.ranking import running_counts
from basketry.plans.labels import (
    BILLED_STATES, CREDIT_CARD, DEVICES, ERP_STATUSES, FAILED_STATES, NO, PAYMENT_CAPTURED, PAYMENT_FAILED, YES,
)
from basketry.plans.users import NO_UTM, UTM_TEXT, add_utm, channel_flags, utm_text
from basketry.session import stage_table


def with_consider(orders: DataFrame, state_map: DataFrame) -> DataFrame:
    """Add `consider` from the state map; a state that is not in the map gives `error`."""
    return lookup(orders, state_map, "state", {"consider": ("consider", "error")})


# ---------------------------------------------------------------- items and totals

STOCKOUT_STATE, CANCELLED_STATE = "cancelled_stockout", "cancelled"


def item_measures(stockout: Column, cancelled: Column) -> dict[str, Column]:
    """Unsold and final quantity and final value of an item, given its unsold quantities."""
    unsold = stockout + cancelled
    final_quantity = F.col("quantity") - unsold
    return {
        "all_stockout_quantity": stockout, "all_cancelled_quantity": cancelled, "unsold_quantity": unsold,
        "final_item_quantity": final_quantity,
        "final_item_value": final_quantity * F.col("final_price") + F.col("shipping_price"),
    }


def original_value() -> Column:
    return F.col("quantity") * F.col("final_price") + F.col("shipping_price") + F.col("stockout_shipping_price")


def priced_items(items: DataFrame, stockout: Column, cancelled: Column) -> DataFrame:
    return items.select(
        "order_id", F.col("id").alias("item_id"), "campaign_id", F.col("variant_id").alias("product_key"),
        "quantity", "final_price", "original_price", original_value().alias("original_item_value"),
        *[c.alias(n) for n, c in item_measures(stockout, cancelled).items()],
    )


def order_items_cube(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items with the whole quantity unsold when the order state says so."""
    states = orders.select(F.col("id").alias("order_id"), F.col("state").alias("order_state"))
    return priced_items(
        natural_left(items, states, "order_id"),
        F.when(F.col("order_state") == STOCKOUT_STATE, F.col("quantity")).otherwise(F.col("stockout_quantity")),
        F.when(F.col("order_state") == CANCELLED_STATE, F.col("quantity")).otherwise(F.col("cancelled_quantity")),
    )


def order_items_plain(items: DataFrame) -> DataFrame:
    """The same columns from the item's own unsold quantities, whatever the order state."""
    return priced_items(items, F.col("stockout_quantity"), F.col("cancelled_quantity"))


# Sum per order -> the item measure it sums.
SUMMED = {
    "final_cancelled_quantity": "all_cancelled_quantity", "final_stockout_quantity": "all_stockout_quantity",
    "final_unsold_quantity": "unsold_quantity", "final_quantity": "final_item_quantity",
    "final_order_value": "final_item_value",
}


def order_totals(cube: DataFrame) -> DataFrame:
    """Item sums per order, from priced items."""
    return cube.groupBy("order_id").agg(
        F.count("item_id").alias("number_of_products"), total("original_item_value").alias("original_order_value"),
        total("quantity").alias("original_quantity"), *[total(m).alias(out) for out, m in SUMMED.items()],
    )


def order_sums(items: DataFrame) -> DataFrame:
    """Item sums per order under each of the three readings an order state can ask for.

    Summing before the items meet the order state combines them on the map side: an order with very
    many items arrives at the join as one row.
    """
    quantity, stockout, cancelled = F.col("quantity"), F.col("stockout_quantity"), F.col("cancelled_quantity")
    readings = {
        "plain": item_measures(stockout, cancelled), STOCKOUT_STATE: item_measures(quantity, cancelled),
        CANCELLED_STATE: item_measures(stockout, quantity),
    }
    return items.groupBy("order_id").agg(
        F.count("id").alias("number_of_products"), total(original_value()).alias("original_order_value"),
        total("quantity").alias("original_quantity"),
        *[total(measures[m]).alias(f"__{r}_{out}") for r, measures in readings.items() for out, m in SUMMED.items()],
    )


def settled(out: str, state: str) -> Column:
    """The reading of a sum that the order state asks for."""
    return (
        F.when(F.col(state) == STOCKOUT_STATE, F.col(f"__{STOCKOUT_STATE}_{out}"))
        .when(F.col(state) == CANCELLED_STATE, F.col(f"__{CANCELLED_STATE}_{out}"))
        .otherwise(F.col(f"__plain_{out}"))
    )


def order_totals_by_state(items: DataFrame, orders: DataFrame) -> DataFrame:
    """The totals of `order_items_cube`, from sums that were taken before the state is known."""
    states = orders.select(F.col("id").alias("order_id"), F.col("state").alias("__state"))
    return natural_left(order_sums(items), states, "order_id").select(
        "order_id", "number_of_products", "original_order_value", "original_quantity",
        *[settled(out, "__state").alias(out) for out in SUMMED],
    )


TOTALS = [
    "original_order_value", "original_quantity", "final_cancelled_quantity", "final_stockout_quantity",
    "final_unsold_quantity", "final_quantity", "final_order_value",
]


def authorized_orders(
    orders: DataFrame, state_map: DataFrame, utms: DataFrame, sums: DataFrame
) -> DataFrame:
    """Orders whose state counts, with cohort, UTM and device, item totals and billed flag.

    `sums` comes from `order_sums`. The filter runs before the joins, so only counted orders are
    shuffled.
    """
    counted = with_consider(orders, state_map).where(F.col("consider") == "yes")
    counted = counted.withColumnRenamed("id", "order_id")
    summed = sums.withColumn("is_considered_order", F.lit(1))
    joined = add_utm(natural_left(counted, summed, "order_id"), utms, "order").withColumns(
        {out: settled(out, "state") for out in SUMMED}
    )
    day = local_date("created_at")
    return joined.select(
        "order_id", "user_id", "state", day.alias("order_date"), month_label(day).alias("order_cohort"),
        F.year(day).alias("order_year"), "order_source", "order_medium", "order_campaign",
        recode("origin", DEVICES, NO_UTM).alias("order_origin"), "order_source_group",
        *[c.alias(n) for n, c in channel_flags().items()], *TOTALS, "is_considered_order",
        F.when(F.col("state").isin(BILLED_STATES), 1).alias("is_billed_order"),
    )


# ---------------------------------------------------------------- first-time buyers

def orders_treated(orders: DataFrame, users: DataFrame, state_map: DataFrame) -> DataFrame:
    """All orders with local dates, sales value, device label and the user's e-mail."""
    people = users.select(F.col("id").alias("user_id"), "email", local_date("created_at").alias("register_date"))
    treated = with_consider(orders, state_map).select(
        F.col("id").alias("order_id"), "user_id", local_date("created_at").alias("created_on"),
        month_start(local_date("created_at")).alias("order_month"), local_date("updated_at").alias("updated_on"),
        F.col("state").alias("order_state"), "consider", F.col("utm_id").alias("order_utm_id"),
        F.col("cached_total_value").alias("basket_value"), F.col("shipping_price").alias("shipping_value"),
        (F.col("cached_total_value") + F.col("shipping_price")).alias("sales_value"),
        F.col("cached_credits").alias("credit_value"), F.col("cached_final_value").alias("final_value"),
        recode("origin", DEVICES).alias("order_origin"), "coupon_id",
    )
    return natural_left(treated, people, "user_id")


def first_time_buyers(orders: DataFrame, date_column: str = "order_date") -> DataFrame:
    """First order id and first order day per user, taken independently of each other."""
    firsts = orders.groupBy("user_id").agg(
        F.min("order_id").alias("first_order_id"), F.min(date_column).alias("first_order_date")
    )
    return firsts.withColumns({"ftb_cohort": month_label("first_order_date"), "ftb_count": F.lit(1)})


def orders_is_ftb(orders: DataFrame, first_buyers: DataFrame) -> DataFrame:
    """Flag (1 or null) on the first order of each user."""
    firsts = first_buyers.select(F.col("first_order_id").alias("order_id"), F.lit(1).alias("is_ftb"))
    return natural_left(orders, firsts, "order_id")


def monthly_buyer_type(orders: DataFrame, first_buyers: DataFrame) -> DataFrame:
    """One row per user and month with orders: first-time buyer of that month, or repeat buyer."""
    months = orders.groupBy("user_id", "order_cohort").agg(F.count("order_id").alias("orders"))
    joined = natural_left(months, first_buyers.select("user_id", "ftb_cohort"), "user_id")
    same = F.col("order_cohort") == F.col("ftb_cohort")
    return joined.select(
        "user_id", "order_cohort", "orders", flag(same).alias("is_ftb_in_month"),
        F.when(same, "FTBs").otherwise("Repeat Buyers").alias("buyer_type"),
    )


def ftb_report_users(first_buyers: DataFrame, users: DataFrame, vips: DataFrame) -> DataFrame:
    """First-time buyers with register cohort and VIP dates."""
    registered = users.select(
        F.col("id").alias("user_id"), local_date("created_at").alias("register_date"),
        month_start(local_date("created_at")).alias("register_cohort"),
    )
    buyers = first_buyers.select(
        "user_id", "first_order_id", "first_order_date", month_start("first_order_date").alias("ftb_month"), "ftb_count"
    )
    return natural_left(natural_left(buyers, registered, "user_id"), vips.drop("utm_id", "origin"), "user_id")


def ftb_report_orders(treated: DataFrame, lifetime_vip: DataFrame, first_buyers: DataFrame) -> DataFrame:
    """Treated orders with the lifetime-VIP flag and the first-buy cohort."""
    vip = lifetime_vip.groupBy("user_id").agg(F.min("vip_since").alias("vip_date"))
    flagged = vip.withColumns({"vip_cohort": month_start("vip_date"), "lifetime_vip": F.lit(1)})
    cohorts = first_buyers.select("user_id", month_start("first_order_date").alias("ftb_cohort"))
    return natural_left(natural_left(treated, flagged, "user_id"), cohorts, "user_id")


# ---------------------------------------------------------------- administrative facts

def orders_admin(orders: DataFrame, users: DataFrame | None, status_names: DataFrame, utms: DataFrame) -> DataFrame:
    """Order with status names, e-mail and UTM text. Without `users` there is no e-mail, and no shuffle by user."""

    def names(kind: str) -> DataFrame:
        return status_names.where(F.col("status_type") == kind)

    named = lookup(orders, names("status"), "status", {"erp_status": ("status_name", None)}, table_key="status_id")
    named = lookup(
        named, names("payment_status"), "payment_status", {"payment_status_name": ("status_name", None)},
        table_key="status_id",
    )
    joined = natural_left(named, utm_text(utms), "utm_id")
    if users is not None:
        joined = natural_left(joined, users.select(F.col("id").alias("user_id"), "email"), "user_id")
    return joined.select(
        F.col("id").alias("order_id"), F.col("masked_id").alias("public_id"), "created_at",
        F.col("user_id").alias("customer_id"), *(["email"] if users is not None else []), "erp_status", "payment_status_name",
        F.col("cached_final_value").alias("order_value"), F.col("cached_total_value").alias("items_value"),
        F.col("shipping_price").alias("shipping_value"), *[f"utm_{c}" for c in UTM_TEXT], "installments",
        F.col("state").alias("order_state"), "credit_card_operator", "payment_method",
    )


def order_inclusion(orders: DataFrame, status_lists: DataFrame) -> DataFrame:
    """Two yes/no flags from the include list (order state) and the two exclude lists.

    An order with a state is included when the state is on the include list; without a state, unless
    an exclude list names its ERP or payment status. The second flag looks at the exclude lists only.
    """
    key = lambda c: F.trim(F.lower(c))
    kept = status_lists.where(F.lower(F.trim("keep")) == "incluir").select(key("state").alias("name"))
    erp = status_lists.select(key("erp_exclude").alias("name"))
    payment = status_lists.select(key("payment_exclude").alias("name"))
    df = orders.withColumns({
        "__state": key("order_state"), "__erp": key("erp_status"), "__payment": key("payment_status_name"),
    })
    df = has_key(df, kept, "__state", "__keep", table_key="name")
    df = has_key(df, erp, "__erp", "__drop_erp", table_key="name")
    df = has_key(df, payment, "__payment", "__drop_payment", table_key="name")
    excluded = (F.col("__drop_erp") == 1) | (F.col("__drop_payment") == 1)
    not_excluded = F.when(excluded, NO).otherwise(YES)
    has_state = F.coalesce("__state", F.lit("-")) != "-"
    return df.withColumns({
        "include_state": F.when(has_state, F.when(F.col("__keep") == 1, YES).otherwise(NO)).otherwise(not_excluded),
        "include_erp_payment": not_excluded,
    }).select(*orders.columns, "include_state", "include_erp_payment")


def admin_items(items: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Item with the parent's and the variant's ERP code and the category name."""
    parents = products.select(
        F.col("id").alias("product_id"), F.col("erp_code").alias("product_code"), "main_category_id"
    )
    variants = products.select(F.col("id").alias("variant_id"), F.col("erp_code").alias("variant_code"))
    named = lookup(
        natural_left(natural_left(items, parents, "product_id"), variants, "variant_id"), categories,
        "main_category_id", {"category": ("name", None)}, table_key="id", unique=True,
    )
    return named.select(
        F.col("id").alias("item_id"), "order_id", F.col("name").alias("product_name"), "quantity",
        F.col("original_price").alias("unit_price"),
        (F.col("quantity") * F.col("original_price")).alias("total_price"), "final_price", "campaign_id",
        "product_code", "variant_code", "category",
    )


def orders_base(orders: DataFrame, reduction: str = "0", unit: str | Column = "main") -> DataFrame:
    """Orders in the five ERP states whose payment did not fail, with net revenue.

    `reduction` is the share taken off gross revenue, as a decimal text such as `0.02`. `unit` is the business
    unit of the orders: a name, or a column over the orders.
    """
    status = lambda c: F.lower(F.trim(c))
    kept = orders.where(
        status("erp_status").isin(ERP_STATUSES) & differs(status("payment_status_name"), PAYMENT_FAILED)
    )
    day = F.to_date("created_at")
    keep_rate = F.lit(1) - F.lit(reduction).cast("decimal(9,6)")
    return kept.select(
        "order_id", "public_id", day.alias("order_date"), month_start(day).alias("month"),
        F.year(day).alias("order_year"), "customer_id",
        F.coalesce(F.trim("erp_status"), F.lit("-")).alias("erp_status"),
        F.coalesce(F.trim("payment_status_name"), F.lit("-")).alias("payment_status"),
        (null_sum("items_value", "shipping_value") * keep_rate).cast("decimal(18,4)").alias("revenue"),
        F.col("shipping_value").alias("shipping_cost_shop"),
        *[f"utm_{c}" for c in UTM_TEXT], (F.lit(unit) if isinstance(unit, str) else unit).alias("unit"),
        F.lit(CREDIT_CARD).alias("payment_form"), "installments",
        flag(status("payment_status_name") == PAYMENT_CAPTURED).alias("payment_confirmed"),
        F.coalesce(status("order_state"), F.lit("-")).alias("order_state"),
        F.col("credit_card_operator").alias("card_operator"),
    )


def order_cardinal(base: DataFrame) -> DataFrame:
    """Number of each order within its customer (all orders; paid orders only) and first-order flags."""
    paid = F.col("payment_confirmed") == 1
    numbered = running_counts(
        base, "customer_id", "order_date", ["public_id", "order_id"],
        {"cardinal": F.lit(True), "cardinal_paid": paid},
    )
    flags = {"is_ftp": flag(F.col("cardinal") == 1), "is_ftp_paid": flag(F.col("cardinal_paid") == 1)}
    if "conversion_factor" in base.columns:
        flags["is_ftp_expected"] = flag(F.col("cardinal") == 1) * F.col("conversion_factor")
    return numbered.withColumns(flags)


def customer_milestones(customers: DataFrame, cardinal: DataFrame) -> DataFrame:
    """First order days, number of orders (0 without any), register day not after the first order."""
    firsts = cardinal.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.min(F.when(F.col("payment_confirmed") == 1, F.col("order_date"))).alias("first_paid_date"),
        F.count("order_id").alias("orders"),
    )
    joined = natural_left(customers, firsts, "customer_id")
    register = F.least("first_order_date", "registered_on")
    return joined.withColumns({"orders": F.coalesce("orders", F.lit(0)), "register_date": register}).withColumns(
        {"register_month": month_start("register_date"), "register_year": F.year("register_date")}
    )


def months_since_first(cardinal: DataFrame, milestones: DataFrame) -> DataFrame:
    """Calendar months from the first and from the first paid order to this order."""
    firsts = milestones.where(F.col("first_order_date").isNotNull()).select(
        "customer_id", "first_order_date", "first_paid_date"
    )
    return natural_left(cardinal, firsts, "customer_id").withColumns({
        "months_ftp": calendar_months_between("order_date", "first_order_date"),
        "months_ftp_paid": calendar_months_between("order_date", "first_paid_date"),
    }).drop("first_order_date", "first_paid_date")


# ---------------------------------------------------------------- conversion estimate

CONVERSION_DAYS = 120
MINIMUM_RATE = 0.02


def conversion_snapshot(base: DataFrame, as_of: dt.date, *, paid_only: bool = True) -> DataFrame:
    """Today's cancellation rates of days 1-30 and 91-120 and their difference, one row per unit.

    `paid_only=False` measures "paid" over the same rows as "total", which makes every rate 0.
    """
    age = days_before(as_of, "order_date")
    paid = F.col("payment_confirmed") == 1 if paid_only else F.lit(True)

    def rate(low: int, high: int) -> Column:
        window = age.between(low, high)
        return F.lit(1.0) - ratio(
            total(F.when(window & paid, F.col("revenue"))), total(F.when(window, F.col("revenue")))
        )

    measured = base.where(age <= CONVERSION_DAYS).groupBy("unit").agg(
        rate(1, 30).alias("rate_1_30"), rate(91, 120).alias("rate_91_120"), total("revenue").alias("revenue")
    )
    return measured.select(
        "unit", F.lit(as_of).alias("day"), "rate_1_30", "rate_91_120",
        (F.col("rate_91_120") - F.col("rate_1_30")).alias("dif"), F.col("revenue").cast("decimal(38,4)").alias("revenue"),
    )


def conversion_history(history: DataFrame, snapshot: DataFrame, as_of: dt.date) -> DataFrame:
    """History without the rows of the run day, plus today's row."""
    return history.where(differs("day", as_of)).select(snapshot.columns).unionByName(snapshot)


def conversion_estimate(
    base: DataFrame, history: DataFrame, as_of: dt.date, units: tuple[str, ...] = ("main",)
) -> DataFrame:
    """Expected revenue: young orders are reduced by the newest rate difference of their unit above 2 %.

    A row without a difference ends the search, like the end of the table does: 2 % applies then. Only the
    given units are estimated; orders of all others count in full. The rates reach the orders as scalar
    subqueries, so the orders are neither joined nor shuffled.
    """
    usable = history.where((F.col("dif") > MINIMUM_RATE) | F.col("dif").isNull())
    left = F.lit(CONVERSION_DAYS) - days_before(as_of, "order_date")
    factor = F.lit(1.0)
    for unit in units:
        own = usable.where(F.col("unit") == unit)
        newest = own.agg(F.max_by(F.struct("dif"), "day").alias("row")).select("row.dif").scalar()
        rate = F.coalesce(newest, F.lit(MINIMUM_RATE))
        reduced = F.lit(1.0) - F.greatest(F.lit(0.0), left * rate / F.lit(CONVERSION_DAYS))
        factor = F.when(F.col("unit") == unit, reduced).otherwise(factor)
    return base.withColumn("conversion_factor", factor).withColumn(
        "expected_revenue", F.col("revenue").cast("double") * F.col("conversion_factor")
    )


# ---------------------------------------------------------------- ad-hoc reports

def monthly_totals(orders: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Orders, basket and shipping per calendar month for website orders that did not fail."""
    kept = orders.where(
        ~F.col("state").isin(FAILED_STATES) & (F.col("origin") == 1) & local_between("created_at", first, last)
    )
    return kept.groupBy(F.month(local_date("created_at")).alias("month")).agg(
        F.count("id").alias("orders"), F.sum("cached_total_value").alias("basket_value"),
        F.sum("shipping_price").alias("shipping"),
    )


def daily_sales(orders: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Placed value per local day for website and mobile-browser orders."""
    kept = orders.where(
        ~F.col("state").isin("auth_failed", "pending") & F.col("origin").isin(1, 5)
        & local_between("created_at", first, last)
    )
    return kept.groupBy(local_date("created_at").alias("order_date")).agg(
        F.count("id").alias("orders"), F.sum("cached_total_value").alias("placed_basket_value"),
        F.sum("shipping_price").alias("placed_shipping"),
        F.sum(F.col("cached_total_value") + F.col("shipping_price")).alias("placed_order_value"),
        F.sum("captured_shipping_price").alias("captured_shipping"),
        F.min(recode("origin", DEVICES)).alias("origin"),
    )


def monthly_registrations(users: DataFrame) -> DataFrame:
    """Registered users per year, month and origin."""
    day = local_date("created_at")
    return users.groupBy(F.year(day).alias("year"), F.month(day).alias("month"), "origin").agg(
        F.count("id").alias("users")
    ).orderBy("year", "month", "origin")


def final_items(orders: DataFrame, items: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Items still sold of valid orders, with their final value."""
    valid = orders.where(
        ~F.col("state").isin(*FAILED_STATES, "cancelled_stockout") & local_between("created_at", first, last)
    ).select(F.col("id").alias("order_id"), "user_id", local_date("created_at").alias("order_date"), "state")
    quantity = F.col("quantity") - (F.col("cancelled_quantity") + F.col("stockout_quantity"))
    sold = items.where(quantity > 0).select(
        "order_id", F.col("id").alias("item_id"), "campaign_id", F.col("variant_id").alias("sku"), "name",
        "final_price", quantity.alias("final_quantity"), F.col("shipping_price").alias("item_shipping_price"),
    )
    # Staged, because the sort reads its input twice, first to draw its ranges: the few rows left, not both sides of the join.
    joined = stage_table(valid.join(sold, "order_id", "inner"))
    basket = F.col("final_price") * F.col("final_quantity")
    columns = [*joined.columns[:-1], basket.alias("basket_value"), "item_shipping_price", (basket + F.col("item_shipping_price")).alias("final_value")]
    return joined.orderBy("order_id", "item_id").select(*columns)


def orders_by_utm(orders: DataFrame, utms: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Placed value per public order number outside the apps, with the order's UTM fields.

    Columns that are not aggregated come from the order with the smallest id.
    """
    kept = orders.where(
        ~F.col("state").isin(FAILED_STATES) & ~F.col("origin").isin(2, 4) & local_between("created_at", first, last)
    )
    summed = kept.groupBy("masked_id").agg(
        F.sum("cached_total_value").alias("placed_basket_value"), F.sum("shipping_price").alias("placed_shipping"),
        F.sum(F.col("cached_total_value") + F.col("shipping_price")).alias("placed_order_value"),
        F.min_by(
            F.struct(local_date("created_at").alias("order_date"), "state",
                     recode("origin", DEVICES).alias("origin"), "utm_id"), "id",
        ).alias("order"),
    ).select("masked_id", "order.*", "placed_basket_value", "placed_shipping", "placed_order_value")
    fields = ["source", "campaign", "medium", "term", "gclid"]
    return natural_left(summed, utms.select(F.col("id").alias("utm_id"), *fields), "utm_id").orderBy(
        "order_date", "masked_id"
    )


def monthly_distinct_products(orders: DataFrame, items: DataFrame, first: dt.date) -> DataFrame:
    """Distinct products sold per calendar month since a day."""
    valid = orders.where(~F.col("state").isin(FAILED_STATES)).select(F.col("id").alias("order_id"))
    recent = items.where(local_since("created_at", first))
    joined = recent.join(valid, "order_id", "inner")
    return joined.groupBy(F.month(local_date("created_at")).alias("month")).agg(
        F.count_distinct("product_id").alias("products")
    )


def users_with_utm(users: DataFrame, utms: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Users registered in a period with their UTM source and medium."""
    kept = users.where(local_between("created_at", first, last)).select(
        local_date("created_at").alias("date"), F.col("id").alias("user_id"), "utm_id"
    )
    fields = utms.select(F.col("id").alias("utm_id"), "source", "medium")
    return natural_left(kept, fields, "utm_id").drop("utm_id")


def order_newest_version(stored: DataFrame, changed: DataFrame) -> DataFrame:
    """Orders table after an incremental load: newest `updated_at` per id wins."""
    return merge_latest(stored, changed, ["id"], "updated_at")


def first_order_of_user(orders: DataFrame) -> DataFrame:
    """The earliest order row (by instant, then id) of each user."""
    return first_by(
        orders, "user_id", ["created_at", "id"], {"order_id": "id", "state": "state", "created_at": "created_at"}
    )
