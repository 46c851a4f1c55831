"""Operations, survey and promotions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import days_before, local_date, month_label, month_start
from basketry.functions.metrics import (
    basket_value, discount, gross_quantity_total, liquid_quantity, liquid_quantity_total, sales_value,
)
from basketry.functions.numbers import flag, total
from basketry.functions.text import recode
from basketry.operators.joins import has_key, natural_left
from basketry.operators.reshape import unpivot_columns
from basketry.plans.labels import FAILED_STATES, RISK_RULE_NAMES, RISK_RULES
from basketry.plans.orders import with_consider

NO_DATA, NOT_DELIVERED, DELIVERED = "no delivery data", "not delivered", "delivered"


def delivery_dates(orders: DataFrame, transitions: DataFrame, totals: DataFrame) -> DataFrame:
    """Shipped, communicated, estimated, actual and best delivery date per order that did not fail.

    Texts such as `not delivered` live in a status column, so the date columns hold dates only. An
    order that was shipped twice counts from its first shipping.
    """
    shipped = transitions.where(F.col("to_state") == "shipping_successful").groupBy("order_id").agg(
        F.min("created_at").alias("shipped_at")
    ).select("order_id", local_date("shipped_at").alias("shipping_date"))
    kept = orders.where(~F.coalesce("state", F.lit("")).isin(FAILED_STATES)).withColumnRenamed("id", "order_id")
    sums = totals.select("order_id", "original_order_value", "final_quantity", "final_order_value", F.lit(1).alias("order_count"))
    joined = natural_left(natural_left(kept, shipped, "order_id"), sums, "order_id")
    status = (
        F.when(F.col("delivered_at").isNotNull(), DELIVERED)
        .when(F.col("state") == "shipping_successful", NO_DATA).otherwise(NOT_DELIVERED)
    )
    dated = joined.withColumns({
        "delivery_status": status,
        "actual_date": local_date("delivered_at"),
        "communicated_date": F.date_add(local_date("created_at"), F.col("total_shipping_time")),
        "estimated_date": F.when(
            F.col("state").isin("shipping_successful", "delivered"),
            F.date_add("shipping_date", F.col("shipping_period")),
        ),
    })
    best = (
        F.when(F.col("delivery_status") == DELIVERED, F.col("actual_date"))
        .when((F.col("delivery_status") == NO_DATA) & F.col("shipping_date").isNotNull(), F.col("estimated_date"))
        .when(F.col("delivery_status") == NO_DATA, F.col("communicated_date"))
    )
    return dated.select(
        "order_id", local_date("created_at").alias("order_date"), "state", F.col("external_id").alias("erp_id"),
        "shipping_period", "total_shipping_time", "shipping_date", "communicated_date", "estimated_date", "actual_date",
        "delivery_status", best.alias("best_date"), "original_order_value", "final_quantity", "final_order_value",
        "order_count",
    )


def risk_rules(results: DataFrame, orders: DataFrame, first_buyers: DataFrame) -> DataFrame:
    """One row per order and evaluated risk rule, with first-purchase flag, order day and cohort."""
    rows = unpivot_columns(results, ["order_id"], RISK_RULES, "rule", "passed").select(
        "order_id", "rule", recode("rule", RISK_RULE_NAMES).alias("rule_name"),
        F.when(F.col("passed") == 0, "Clearsale").otherwise("Whitelist").alias("rule_applies"),
    )
    heads = has_key(orders, first_buyers, "id", "__first", table_key="first_order_id").select(
        F.col("id").alias("order_id"), F.when(F.col("__first") == 1, "yes").otherwise("no").alias("ftp"),
        local_date("created_at").alias("order_date"), month_label(local_date("created_at")).alias("order_cohort"),
        "external_id",
    )
    return natural_left(rows, heads, "order_id")


def risk_final_list(rules: DataFrame) -> DataFrame:
    """Clearsale when any rule says so, else Whitelist; one row per order."""
    listed = F.max(F.when(F.col("rule_applies") == "Clearsale", 1).otherwise(0))
    return rules.groupBy("order_id").agg(
        F.when(listed == 1, "Clearsale").otherwise("Whitelist").alias("final_list"), F.lit(1).alias("risk_analysis_data")
    )


def nps_group(score: Column | str) -> Column:
    column = F.col(score) if isinstance(score, str) else score
    return F.when(column >= 9, "Promoters").when(column < 7, "Detractors").otherwise("Passives")


def nps_groups(survey: DataFrame, as_of: dt.date, since: dt.date = dt.date(2015, 1, 31)) -> DataFrame:
    """Valid answers after a day, with group, month and last-30-days flag."""
    valid = survey.where(
        F.col("score").between(0, 10) & (F.col("answered_at") > F.lit(since).cast("timestamp"))
    )
    day = F.to_date("answered_at")
    return valid.select(
        "response_id", "email", day.alias("answer_date"), month_start(day).alias("answer_month"), "score",
        nps_group("score").alias("nps_group"), "reason", "customer_id", "order_id",
        flag(days_before(as_of, day) <= 30).alias("last_30_days"),
    )


CREDIT_VALUE = 5


def credits(raw: DataFrame) -> DataFrame:
    """Used credits with the day and month of use and the fixed credit value."""
    day = local_date("used_at")
    return raw.where(F.col("used_at").isNotNull()).select(
        F.col("id").alias("credit_id"), day.alias("date_used"), month_start(day).alias("month_used"),
        F.lit(CREDIT_VALUE).alias("credit_value"), "credit_type", "invited_id", "order_id",
        F.to_date("cancelled_at").alias("cancelled_on"), "origin_id",
    )


def orders_with_coupon(orders: DataFrame, coupons: DataFrame, state_map: DataFrame) -> DataFrame:
    """Orders with the terms of their coupon, the coupon rate and the coupon value."""
    terms = coupons.select(
        F.col("id").alias("coupon_id"), "code", "value", (F.col("value") / 100).cast("decimal(18,6)").alias("coupon_percent"),
        "user_constraint", "order_constraint", "channel_constraint", "enabled", "min_order_value",
    )
    heads = with_consider(orders, state_map).select(
        F.col("id").alias("order_id"), "user_id", "cached_total_value", local_date("created_at").alias("order_date"),
        month_start(local_date("created_at")).alias("order_month"), "consider", "coupon_id",
    )
    return natural_left(heads, terms, "coupon_id").withColumn(
        "coupon_value", F.col("cached_total_value") * F.col("coupon_percent")
    )


def sales_metrics(items: DataFrame, keys: list[str]) -> DataFrame:
    """The sales metrics per group of items."""
    return items.groupBy(*keys).agg(
        gross_quantity_total().alias("gross_quantity"), liquid_quantity_total().alias("liquid_quantity"),
        total(basket_value()).alias("basket_value"), total(sales_value()).alias("sales_value"),
        F.min(discount()).alias("deepest_discount"),
        total(liquid_quantity() * F.col("final_price")).alias("total_value"),
    )
