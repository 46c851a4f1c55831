"""Customer lifecycle: lifetime value, e-mail, marketing spend, scoring, segments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.dates import days_before, month_start
from basketry.functions.numbers import flag, ratio, total
from basketry.functions.text import differs
from basketry.operators.joins import full_on, natural_left, semi
from basketry.operators.ranking import number_months, rank_buckets
from basketry.operators.reshape import stack_frames, unpivot_columns
from basketry.plans.labels import NO, NOT_AVAILABLE, YES
from basketry.plans.margin import MONTH_UNIT, unit_monthly
from basketry.session import stage_table

# ---------------------------------------------------------------- lifetime value


def ltv_curve(orders: DataFrame, milestones: DataFrame) -> DataFrame:
    """Revenue per acquired customer by months since the first order, and its month-on-month ratio.

    Distance d divides by the customers of the cohorts that are old enough: with cohorts numbered
    from 0, those up to (largest distance - d). After the two grouped sums only calendar-sized
    tables are left, and the windows run over those.
    """
    revenue = orders.where(F.col("months_ftp").isNotNull()).groupBy(F.col("months_ftp").alias("distance")).agg(
        F.sum("revenue").alias("revenue")
    )
    cohorts = milestones.where(F.col("first_order_date").isNotNull()).groupBy(
        month_start("first_order_date").alias("month")
    ).agg(F.count("customer_id").alias("cohort_users"))
    numbered = number_months(cohorts, ["month"], "row")
    upto = Window.orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cumulated = numbered.select((F.col("row") - 1).alias("row"), F.sum("cohort_users").over(upto).alias("users"))
    last_row = cumulated.agg(F.max("row")).scalar()
    farthest = F.max("distance").over(Window.partitionBy())
    keyed = revenue.withColumn("row", F.least(farthest - F.col("distance"), last_row))
    curve = natural_left(keyed, cumulated, "row").select(
        "distance", "revenue", "users", ratio(F.col("revenue"), F.col("users")).alias("ltv")
    )
    before = curve.select((F.col("distance") + 1).alias("distance"), F.col("ltv").alias("ltv_previous"))
    return natural_left(curve, before, "distance").withColumn(
        "ltv_ratio", ratio(F.col("ltv"), F.col("ltv_previous"))
    )


def ltv_summary(curve: DataFrame) -> DataFrame:
    """Ratio of the first month and mean ratio of months 2-12 (later months are too thin)."""
    return curve.agg(
        total(F.when(F.col("distance") == 1, F.col("ltv_ratio"))).alias("first_ratio"),
        F.avg(F.when((F.col("distance") > 1) & (F.col("distance") <= 12), F.col("ltv_ratio"))).alias("mean_ratio"),
    )


def contribution_margin(orders: DataFrame, margins: DataFrame) -> DataFrame:
    """Contribution margin with and without fulfilment at the rates of the month and unit."""
    joined = natural_left(orders, unit_monthly(margins, ["margin_with", "margin_without"]), MONTH_UNIT)
    return joined.withColumns({
        "margin_with_fulfilment": F.col("revenue") * F.col("margin_with"),
        "margin_without_fulfilment": F.col("revenue") * F.col("margin_without"),
    }).drop("margin_with", "margin_without")


# ---------------------------------------------------------------- e-mail

def dated_name(name: str, fallback: Column) -> Column:
    """Day from an eight-digit name prefix, else the fallback."""
    prefix = F.left(F.col(name), F.lit(8))
    return F.when(prefix.rlike("^[0-9]{8}$"), F.to_date(F.try_to_timestamp(prefix, F.lit("yyyyMMdd")))).otherwise(fallback)


def email_send_summary(
    sends: DataFrame, visits: DataFrame, transactions: DataFrame, unit: str = "main"
) -> DataFrame:
    """Sends, opens and clicks per e-mail and day, with the visits and revenue it brought.

    Visits and transactions are summed per e-mail and day before they meet, so neither repeats the
    other's rows.
    """
    typed = F.when(F.left("email_name", F.lit(8)).rlike("^[0-9]{8}$"), F.substr("email_name", F.lit(10))).otherwise("Other")
    summed = sends.withColumns({
        "email_date": dated_name("email_name", F.to_date("send_started")), "email_type": typed, "unit": F.lit(unit),
    }).groupBy("email_name", "email_date", "email_type", "unit").agg(
        F.sum("sends").alias("sends"), F.sum("deliveries").alias("deliveries"), F.sum("opens").alias("opens"),
        F.sum("clicks").alias("clicks"), F.sum("unsubscribes").alias("unsubscribes"),
    )

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("email_date", dated_name("source", F.col("date"))).withColumnRenamed("source", "email_name")

    key = ["email_name", "email_date"]
    seen = keyed(visits).groupBy(*key).agg(F.sum("visits").alias("visits"))
    bought = keyed(transactions).groupBy(*key).agg(
        F.count_distinct("transaction_id").alias("transactions"), F.sum("revenue").alias("revenue")
    )
    web = full_on(seen, bought, key)
    return natural_left(summed, web, key).withColumns({
        "email_month": month_start("email_date"), "email_year": F.year("email_date"),
        "transactions": F.coalesce("transactions", F.lit(0)),
    })


AGE_BANDS = [(15, "0 - 15 dias"), (30, "15 - 30 dias"), (45, "30 - 45 dias")]
OLDEST_BAND = "45 - 60 dias"


def age_band(age: Column) -> Column:
    chain = F.when(age.isNull(), None)
    for limit, label in AGE_BANDS:
        chain = chain.when(age <= limit, label)
    return chain.otherwise(OLDEST_BAND)


def email_engagement(
    customers: DataFrame, unsubscribes: DataFrame, opens: DataFrame, as_of: dt.date
) -> DataFrame:
    """Unsubscribed and opened flags, last open day, its age (60 at most) and age band."""
    gone = unsubscribes.select("email").distinct().withColumn("__gone", F.lit(1))
    opened = opens.groupBy("email").agg(F.max("opened_on").alias("last_open"), F.lit(1).alias("__opened"))
    joined = natural_left(natural_left(customers, gone, "email"), opened, "email")
    age = days_before(as_of, "last_open")
    return joined.withColumns({
        "open_age": F.when(F.col("last_open").isNotNull(), F.least(age, F.lit(60))), "open_band": age_band(age),
        "opened": F.when(F.col("__opened") == 1, YES).otherwise(NO),
        "unsubscribed": F.when(F.col("__gone") == 1, YES).otherwise(NO),
    }).drop("__gone", "__opened")


# ---------------------------------------------------------------- marketing spend

def marketing_spend(
    spend: DataFrame, split: DataFrame, allocation: DataFrame, months: dict[dt.date, str], units: tuple[str, str]
) -> DataFrame:
    """Monthly spend by name, split between two units and spread over channels by percentage.

    `months` maps a month to its sheet column; `units` is (unit that gets the split share, other).
    """
    amounts = unpivot_columns(spend, ["name"], months, "month", "amount")
    shares = unpivot_columns(split, ["name"], months, "month", "share")
    joined = full_on(amounts, shares, ["name", "month"])
    main, other = units
    both = stack_frames(
        joined.select("name", "month", (F.col("amount") * F.col("share")).alias("amount"), F.lit(main).alias("unit")),
        joined.select(
            "name", "month", (F.col("amount") * (F.lit(1) - F.col("share"))).alias("amount"), F.lit(other).alias("unit")
        ),
    )
    spread = full_on(both, allocation, ["name", "unit"])
    return spread.withColumn("value", F.col("amount") * F.col("percent")).where(F.col("value") > 0).select(
        "month", "name", "purpose", "payment", "channel", "unit", F.col("value").cast("decimal(18,4)").alias("value")
    )


def acquisition_cost(spend: DataFrame) -> DataFrame:
    """Activation and acquisition spend per month, unit and channel."""
    return spend.groupBy("month", "unit", F.coalesce("channel", F.lit(NOT_AVAILABLE)).alias("channel")).agg(
        total(F.when(F.col("purpose").isin("Activation", "Acquisition"), F.col("value"))).alias("cost")
    )


# ---------------------------------------------------------------- scoring and segments

def rfm_score(paid_orders: DataFrame) -> DataFrame:
    """Quintiles of revenue, frequency and recency (1 is best) and the weighted score.

    Each quintile is a rank over all customers, taken on the per-customer sums, which are stored once and never sorted.
    """
    customers = stage_table(paid_orders.groupBy("customer_id").agg(
        F.sum("revenue").alias("revenue"), F.count("order_id").alias("frequency"), F.max("order_date").alias("recency")
    ))
    r, f, m, tie = ("recency", True), ("frequency", True), ("revenue", True), ("customer_id", False)
    ranked = rank_buckets(customers, {"m_class": [m, f, r, tie], "f_class": [f, m, r, tie], "r_class": [r, m, f, tie]}, 5)
    score = (6 - F.col("r_class")) + 2 * (6 - F.col("f_class")) + 3 * (6 - F.col("m_class"))
    return ranked.withColumn("score", score).withColumn("is_vip", F.when(F.col("score") >= 27, YES).otherwise(NO))


def optin_active(customers: DataFrame, paid_orders: DataFrame, as_of: dt.date) -> DataFrame:
    """Opt-in flag, activity flag (opened mail, or registered in the last 30 days), paid orders."""
    paid = semi(paid_orders, customers.select("customer_id"), "customer_id").groupBy("customer_id").agg(
        F.count("order_id").alias("paid_orders"), F.min("order_date").alias("first_paid_order_date")
    )
    joined = natural_left(customers, paid, "customer_id")
    return joined.withColumns({
        "is_opt_in": flag((F.col("opt_in") == YES) & differs("unsubscribed", YES)),
        "is_active": flag(F.col("last_open").isNotNull() | (days_before(as_of, "register_date") <= 30)),
        "paid_orders": F.coalesce("paid_orders", F.lit(0)),
    })


def days_since_previous_order(cardinal: DataFrame, milestones: DataFrame) -> DataFrame:
    """Days from the customer's previous order, or from registration for the first.

    The previous order is found by (customer, number + 1): that key is unique, so the join spreads a
    customer with very many orders evenly, which a window over the customer would not.
    """
    previous = cardinal.select(
        "customer_id", (F.col("cardinal") + 1).alias("cardinal"), F.col("order_date").alias("__previous")
    )
    registered = milestones.select("customer_id", "register_date")
    joined = natural_left(natural_left(cardinal, previous, ["customer_id", "cardinal"]), registered, "customer_id")
    since = F.when(F.col("cardinal") > 1, F.col("__previous")).otherwise(F.col("register_date"))
    return joined.withColumn("days_since_previous", F.datediff("order_date", since)).drop("__previous", "register_date")


def client_segments(customers: DataFrame) -> DataFrame:
    """Customers per unit by opt-in, purchase history, VIP and activity (`customers`: one row each)."""
    opted = F.col("is_opt_in") == 1
    bought = F.coalesce("paid_orders", F.lit(0))
    active, inactive = F.col("is_active") == 1, differs("is_active", 1)
    vip, regular = F.col("is_vip").eqNullSafe(YES), differs("is_vip", YES)
    segments = {
        "never_bought": bought == 0, "ftb": regular & (bought == 1), "vip": vip & (bought >= 1),
        "repeat": regular & (bought > 1),
    }
    columns = {"total": F.lit(True), "opt_in": opted, "opt_out": differs("is_opt_in", 1), "buyers": opted & (bought >= 1)}
    for name, condition in segments.items():
        columns |= {
            name: opted & condition, f"{name}_active": opted & condition & active,
            f"{name}_inactive": opted & condition & inactive,
        }
    return customers.groupBy("unit").agg(*[F.count_if(c).alias(n) for n, c in columns.items()])


def churn_snapshot(customers: DataFrame, as_of: dt.date) -> DataFrame:
    """Active and inactive customers by opt-in and channel on the run day (`customers`: one row each)."""
    opted, not_opted = F.col("is_opt_in") == 1, differs("is_opt_in", 1)
    active, inactive = F.col("is_active") == 1, differs("is_active", 1)
    return customers.groupBy("level1", "level2", "level3", "unit").agg(
        F.count("customer_id").alias("customers"), F.count_if(active & opted).alias("active_opt_in"),
        F.count_if(active & not_opted).alias("active_opt_out"), F.count_if(inactive & opted).alias("inactive_opt_in"),
        F.count_if(inactive & not_opted).alias("inactive_opt_out"),
    ).withColumn("churn_date", F.lit(as_of))


def rfm_export(customers: DataFrame) -> DataFrame:
    """Scored customers with paid orders, best score first."""
    return customers.where(F.col("paid_orders") > 0).select(
        "unit", "email", "customer_id", "register_date", "first_order_date", "level1", "level2", "score", "is_vip",
        "recency", "frequency", F.round("revenue", 2).alias("revenue"), "r_class", "f_class", "m_class",
    ).orderBy(F.col("score").desc_nulls_last(), "email")


def orders_cardinal_export(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Numbered orders with their customer, in date order."""
    people = customers.select("customer_id", "email", "register_date")
    return natural_left(orders, people, "customer_id").select(
        "customer_id", "email", "register_date", "order_id", "public_id", "order_date",
        F.when(F.col("payment_confirmed") == 1, YES).otherwise(NO).alias("payment_confirmed"), "cardinal",
        "cardinal_paid", "days_since_previous", "order_source", "order_medium", "order_campaign", "card_operator",
        "installments", "revenue", "erp_status",
    ).orderBy("order_date", "order_id")
