"""Channels and users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import local_date, month_label, month_start, quarter_start
from basketry.functions.numbers import flag
from basketry.functions.text import blank, differs, recode, wildcard_any
from basketry.operators.grouping import first_by
from basketry.operators.joins import lookup, natural_left, semi
from basketry.plans.labels import (
    APP_ORIGINS, DESKTOP_ORIGINS, DEVICES, MOBILE_BROWSER_ORIGIN, NO, NOT_AVAILABLE, SUBSCRIPTION, YES,
)

NO_UTM = "no utm"


def group_of_source(source: Column | str) -> Column:
    """Marketing group of a UTM source; the first group that matches wins, so a source has one group."""
    text = F.col(source) if isinstance(source, str) else source
    return (
        F.when(wildcard_any(text, "*emkt*", "*welcome*", "*howit*", "*baseat*"), "emkt")
        .when(wildcard_any(text, "*push*"), "push")
        .when(wildcard_any(text, "*direct*"), "direct")
        .when(text == "null", "unattributed")
        .when(~wildcard_any(text, "*null*"), "other")
    )


def source_groups(utms: DataFrame) -> DataFrame:
    """Distinct UTM sources (null as the text `null`) with their group."""
    named = utms.select(F.coalesce("source", F.lit("null")).alias("source")).distinct()
    return named.withColumn("source_group", group_of_source("source"))


def utm_cube(utms: DataFrame) -> DataFrame:
    """UTM rows without nulls, with the group computed in place of a join on the source."""
    text = {c: F.coalesce(c, F.lit("null")) for c in ("source", "medium", "campaign")}
    filled = utms.select(F.col("id").alias("utm_id"), *[v.alias(k) for k, v in text.items()])
    return filled.withColumn("source_group", group_of_source("source"))


def add_utm(df: DataFrame, utms: DataFrame, prefix: str) -> DataFrame:
    """Source, medium, campaign and group of `utm_id` from one lookup of the UTM table."""
    table = utms.withColumn("source_group", group_of_source(F.coalesce("source", F.lit("null"))))
    columns = ("source", "medium", "campaign", "source_group")
    take = {f"{prefix}_{c}": (c, NO_UTM) for c in columns}
    return lookup(df, table, "utm_id", take, table_key="id", unique=True)


def channel_flags(prefix: str = "via") -> dict[str, Column]:
    return {
        f"{prefix}_app": flag(F.col("origin").isin(APP_ORIGINS)),
        f"{prefix}_mobile_browser": flag(F.col("origin") == MOBILE_BROWSER_ORIGIN),
        f"{prefix}_desktop": flag(F.col("origin").isin(DESKTOP_ORIGINS)),
    }


def users_cube(users: DataFrame, utms: DataFrame, app_sessions: DataFrame) -> DataFrame:
    """User with UTM fields, device, opt-in, cohorts and access flags; one row per user."""
    latest = app_sessions.groupBy("user_id").agg(F.max("most_recent_access").alias("app_access"))
    joined = natural_left(add_utm(users.withColumnRenamed("id", "user_id"), utms, "user"), latest, "user_id")
    registered, web, app = local_date("created_at"), local_date("most_recent_access"), local_date("app_access")
    return joined.select(
        "user_id", "email", "first_name", "last_name", "gender", F.col("subscribed").alias("is_opt_in"),
        recode("subscribed", SUBSCRIPTION, "null").alias("email_subscription"),
        "user_source", "user_medium", "user_campaign",
        recode("origin", DEVICES, NO_UTM).alias("user_origin"), "user_source_group",
        registered.alias("register_date"), F.year(registered).alias("register_year"),
        month_label(registered).alias("register_cohort"),
        web.alias("last_web_access_date"), month_label(web).alias("web_access_cohort"),
        *[c.alias(n) for n, c in channel_flags("registered_via").items()],
        flag(F.col("most_recent_access").isNotNull()).alias("accessed_via_web"),
        F.when(F.col("app_access").isNotNull(), 1).alias("accessed_via_app"),
        app.alias("last_app_access_date"), month_label(app).alias("app_access_cohort"),
    )


def users_buyer_flag(users: DataFrame, first_buyers: DataFrame) -> DataFrame:
    """Buyer flag and first-buy cohort on every user; non-buyers get 0."""
    joined = natural_left(users, first_buyers.select("user_id", "ftb_cohort"), "user_id")
    return joined.withColumns({
        "is_buyer": flag(F.col("ftb_cohort").isNotNull()),
        "ftb_cohort": F.coalesce("ftb_cohort", F.lit("0")),
    })


def vip_cohorts(users: DataFrame) -> DataFrame:
    """VIP users with the day, month and quarter they became VIP."""
    day = local_date("vip_since")
    return users.where(F.col("vip_since").isNotNull()).select(
        F.col("id").alias("user_id"), F.col("email").alias("vip_email"), "utm_id", "origin",
        F.lit(1).alias("vip_count"), day.alias("vip_date"), month_start(day).alias("vip_cohort"),
        quarter_start(day).alias("vip_quarter"),
    )


def newest_address(addresses: DataFrame) -> DataFrame:
    return first_by(addresses, "user_id", ["id"], ["city", "state"], latest=True)


def users_with_address(users: DataFrame, addresses: DataFrame) -> DataFrame:
    """City and state of the newest address row of each user."""
    people = users.select(F.col("id").alias("user_id"), "email")
    return natural_left(people, newest_address(addresses), "user_id")


def users_main_address(users: DataFrame, addresses: DataFrame) -> DataFrame:
    """First-registration data with the main address."""
    places = addresses.select(F.col("id").alias("main_address_id"), "city", "state")
    joined = natural_left(users, places, "main_address_id")
    return joined.select(
        F.col("id").alias("user_id"), F.col("email").alias("first_register_email"),
        local_date("created_at").alias("first_register_date"), "first_name", "last_name",
        F.col("origin").alias("first_register_origin"), "main_address_id", "city", "state",
    )


UTM_TEXT = ["source", "campaign", "medium", "term", "content", "gclid"]


def utm_text(utms: DataFrame) -> DataFrame:
    """UTM columns as text with nulls emptied, named `utm_*`."""
    return utms.select(
        F.col("id").alias("utm_id"), *[F.coalesce(c, F.lit("")).alias(f"utm_{c}") for c in UTM_TEXT]
    )


def customers_admin(users: DataFrame, utms: DataFrame, addresses: DataFrame) -> DataFrame:
    """User with UTM text, opt-in label and newest address."""
    people = natural_left(users, utm_text(utms), "utm_id").withColumnRenamed("id", "customer_id")
    places = newest_address(addresses).withColumnRenamed("user_id", "customer_id")
    return natural_left(people, places, "customer_id").select(
        "customer_id", "email", "created_at", F.to_date("created_at").alias("registered_on"),
        *[f"utm_{c}" for c in UTM_TEXT],
        F.when(F.col("subscribed") == 1, YES).otherwise(NO).alias("opt_in"), "gender", "city", "state",
    )


def customer_source(customers: DataFrame, web_events: DataFrame, unit: str = "main") -> DataFrame:
    """Channel of a customer: the shop's own UTM, else the first web event, else `n/a`.

    A missing UTM row counts as an empty source, so the fallback applies to it too.
    """
    seen = first_by(
        web_events, "customer_id", ["date", "event_id"],
        {"web_source": "source", "web_medium": "medium", "web_campaign": "campaign"},
    )
    own = ~blank("utm_source")
    chosen = {
        f"customer_{c}": F.when(own, F.col(f"utm_{c}")).otherwise(
            F.coalesce(f"web_{c}", F.lit(NOT_AVAILABLE))
        )
        for c in ("source", "medium", "campaign")
    }
    joined = natural_left(customers, seen, "customer_id").withColumns(chosen).withColumn("unit", F.lit(unit))
    return joined.drop("web_source", "web_medium", "web_campaign", "utm_source", "utm_medium", "utm_campaign")


def customers_states(customers: DataFrame, orders: DataFrame, states: DataFrame) -> DataFrame:
    """Customers of the loaded orders: sex label, and the state only when the state table knows it."""
    known = states.select(F.trim("state").alias("state"), F.trim("region").alias("region"))
    kept = semi(customers, orders.select("customer_id"), "customer_id").withColumn(
        "__state", F.trim(F.upper("state"))
    )
    looked = lookup(
        kept.drop("state"), known, "__state", {"state": ("state", None), "region": ("region", None)},
        table_key="state",
    )
    sex = F.when(F.col("gender") == "m", "Homem").when(F.col("gender") == "f", "Mulher")
    return looked.select("customer_id", sex.alias("sex"), "state", "region")


def non_buyers(users: DataFrame) -> DataFrame:
    """Users whose buyer flag is not 1 (a null flag counts as not 1)."""
    return users.where(differs("is_buyer", 1))
