"""Channel attribution, costs and margin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import parse_day_first
from basketry.functions.numbers import money, null_sum, ratio, total
from basketry.functions.text import blank
from basketry.operators.allocation import share_of_total
from basketry.operators.grouping import first_by
from basketry.operators.joins import anti, full_on, left_many, lookup, month_table, natural_left
from basketry.operators.reshape import stack_frames, unpivot_columns
from basketry.operators.rules import match_rules
from basketry.plans.labels import BOLETO, CREDIT_CARD, DEBIT, NOT_AVAILABLE

CHANNEL_KEY = ["source", "medium", "campaign", "unit"]
LEVELS = ["level1", "level2", "level3"]
MONTH_UNIT = ["month", "unit"]
RULE_FIELDS = {
    "source": ("exact_source", "like_source"),
    "medium": ("exact_medium", "like_medium"),
    "campaign": ("exact_campaign", "like_campaign"),
}


# ---------------------------------------------------------------- channels

def order_attribution(base: DataFrame, transactions: DataFrame) -> DataFrame:
    """Source, medium and campaign of the web-analytics transaction, else the shop's own."""
    fields = ["source", "medium", "campaign"]
    seen = first_by(
        transactions, ["public_id", "date"], [*fields, "revenue"],
        {**{f"web_{f}": f for f in fields}, "web_revenue": "revenue"},
    ).withColumnRenamed("date", "order_date")
    joined = natural_left(base, seen, ["public_id", "order_date"])
    chosen = {f"order_{f}": F.coalesce(f"web_{f}", f"utm_{f}") for f in fields}
    return joined.withColumns(chosen).drop(*[f"web_{f}" for f in fields], *[f"utm_{f}" for f in fields])


def channel_counts(
    orders_admin: DataFrame, transactions: DataFrame, customers: DataFrame, unit: str = "main"
) -> DataFrame:
    """Registrations per (source, medium, campaign, unit) summed over orders, web transactions, customers."""
    fields = ["source", "medium", "campaign"]

    def counted(df: DataFrame, prefix: str, what: str) -> DataFrame:
        named = df.select(*[F.col(f"{prefix}{f}").alias(f) for f in fields], F.lit(unit).alias("unit"), what)
        return named.groupBy(*CHANNEL_KEY).agg(F.count(what).alias("registrations"))

    parts = stack_frames(
        counted(orders_admin, "utm_", "order_id"),
        counted(transactions.where(F.col("public_id") != "transactionId"), "", "public_id"),
        counted(customers, "customer_", "customer_id"),
    )
    return parts.groupBy(*CHANNEL_KEY).agg(F.sum("registrations").alias("registrations"))


def channel_rules(counts: DataFrame, rules: DataFrame, unit: str = "main") -> DataFrame:
    """Three-level channel of each field combination by the first rule that accepts it."""
    matched = match_rules(counts.where(F.col("unit") == unit), rules, RULE_FIELDS, LEVELS)
    return matched.where(F.col("rule_no").isNotNull()).select(*CHANNEL_KEY, *LEVELS, "rule_no")


def untreated_channels(counts: DataFrame, rules: DataFrame) -> DataFrame:
    """Field combinations no rule accepts, largest first."""
    matched = match_rules(counts, rules, RULE_FIELDS, LEVELS)
    return matched.where(F.col("level1").isNull()).select(
        "source", "medium", "campaign", "registrations"
    ).orderBy(F.col("registrations").desc(), "source", "medium", "campaign")


def click_id_rule(level: str, search: str, display: str) -> Column:
    """Override of a missing channel by the ad click id: with a term it is search, without display."""
    open_channel = blank("level1") | (F.trim("level1") == NOT_AVAILABLE)
    clicked = ~blank("utm_gclid") & open_channel
    without_term = F.coalesce("utm_term", F.lit("")) == ""
    return (
        F.when(clicked & ~blank("utm_term"), search).when(clicked & without_term, display).otherwise(F.col(level))
    )


def channel_apply(df: DataFrame, channels: DataFrame, prefix: str) -> DataFrame:
    """Channel levels on orders (`prefix` order_) or customers (customer_): `n/a` when no rule, then the
    click-id rule."""
    fields = ["source", "medium", "campaign"]
    table = channels.select(*[F.col(f).alias(f"{prefix}{f}") for f in fields], "unit", *LEVELS)
    joined = natural_left(df, table, [*[f"{prefix}{f}" for f in fields], "unit"]).withColumns(
        {level: F.coalesce(level, F.lit(NOT_AVAILABLE)) for level in LEVELS}
    )
    return joined.withColumns({
        "level1": click_id_rule("level1", "Paid Search", "Display Ads"),
        "level2": click_id_rule("level2", "Google Search", "Google DCO"),
        "level3": click_id_rule("level3", "", ""),
    })


# ---------------------------------------------------------------- monthly sheets

def monthly(sheet: DataFrame, columns: list[str], how=F.min) -> DataFrame:
    """A month sheet reduced to one row per month, marked for broadcasting (bound: see month_table)."""
    return month_table(sheet.groupBy("month").agg(*[how(c).alias(c) for c in columns]))


def unit_monthly(sheet: DataFrame, columns: list[str], how=F.min) -> DataFrame:
    """A sheet reduced to one row per month and business unit.

    Units are not bounded by the calendar, so there is no hint: the sheet is broadcast if its size allows, else the hot
    months of the facts are split by the skew handling.
    """
    return sheet.groupBy(*MONTH_UNIT).agg(*[how(c).alias(c) for c in columns])


def shipping_adjust(base: DataFrame, factors: DataFrame) -> DataFrame:
    """Shipping cost times the factor of the month and unit (1 without a factor)."""
    joined = natural_left(base, unit_monthly(factors, ["factor"]), MONTH_UNIT)
    adjusted = (F.col("shipping_cost_shop") * F.coalesce("factor", F.lit(1))).cast("decimal(18,4)")
    return joined.withColumn("shipping_cost", adjusted).drop("factor")


def item_cost(
    base: DataFrame, items: DataFrame, erp_products: DataFrame, erp_stock: DataFrame, raw_items: DataFrame | None = None
) -> DataFrame:
    """ERP unit cost of each item, by the month and unit of its order and its product.

    `raw_items`: the table that `items` was made from, where hot orders are found without making `items`.
    """
    heads = base.select("order_id", *MONTH_UNIT)
    lines = left_many(
        heads, items.select("item_id", "order_id", "product_name", "variant_code", "quantity"), "order_id", raw_items
    )
    coded = lookup(lines, erp_products, "variant_code", {"erp_product_id": ("erp_product_id", None)})
    costs = erp_stock.groupBy(*MONTH_UNIT, "erp_product_id").agg(F.min("unit_cost").alias("unit_cost"))
    return natural_left(coded, costs, [*MONTH_UNIT, "erp_product_id"])


def previous_month(base: DataFrame) -> Column:
    """The month before the newest order month, as a scalar subquery."""
    return base.agg(F.add_months(F.max("month"), -1).alias("month")).scalar()


def frozen_order_cost(base: DataFrame, costs: DataFrame, history: DataFrame) -> DataFrame:
    """Product cost per order: the stored history wins, else computed for the last two months."""
    stored = history.groupBy("order_id").agg(F.min("product_cost").alias("stored_cost"))
    recent = costs.where(F.col("month") >= previous_month(base))
    computed = recent.groupBy("order_id").agg(
        total(F.col("unit_cost") * F.col("quantity")).alias("computed_cost")
    )
    joined = natural_left(natural_left(base, stored, "order_id"), computed, "order_id")
    return joined.withColumn("product_cost", F.coalesce("stored_cost", "computed_cost").cast("decimal(18,4)")).drop(
        "stored_cost", "computed_cost"
    )


def previous_month_costs(costed: DataFrame) -> DataFrame:
    return costed.where(F.col("month") == previous_month(costed)).select("order_id", "product_cost")


def unfrozen_costs(costed: DataFrame, history: DataFrame) -> DataFrame:
    """Orders of the previous month that the history does not have yet."""
    return anti(previous_month_costs(costed), history, "order_id")


def new_cost_history(costed: DataFrame, history: DataFrame) -> DataFrame:
    """History plus the orders of the previous month; a stored cost never changes."""
    fresh = previous_month_costs(costed).withColumnRenamed("product_cost", "new_cost")
    merged = full_on(history.select("order_id", "product_cost"), fresh, "order_id")
    return merged.select("order_id", F.coalesce("product_cost", "new_cost").alias("product_cost"))


def taxes(costed: DataFrame, rates: DataFrame) -> DataFrame:
    """Taxes on revenue, product cost and freight at the rates of the month and unit."""
    joined = natural_left(costed, unit_monthly(rates, ["revenue_rate", "product_rate", "freight_rate"]), MONTH_UNIT)
    return joined.withColumns({
        "revenue_tax": F.col("revenue") * F.col("revenue_rate"),
        "product_tax": F.col("product_cost") * F.col("product_rate"),
        "freight_tax": F.col("shipping_cost") * F.col("freight_rate"),
    }).drop("revenue_rate", "product_rate", "freight_rate")


def with_payment_form(base: DataFrame, methods: DataFrame) -> DataFrame:
    """The orders' payment form by their (order_id, payment_method); cards are the rest."""
    form = (
        F.when(F.col("payment_method") == "boleto", BOLETO).when(F.col("payment_method") == "debit", DEBIT)
        .otherwise(CREDIT_CARD)
    )
    return base.join(methods, "order_id").withColumn("payment_form", form)


def payment_fee(base: DataFrame, fees: DataFrame) -> DataFrame:
    """Fee of the month by payment form, and by number of instalments (1-12) for cards.

    The twelve rate columns become rows and one join replaces twelve.
    """
    card = unpivot_columns(fees, ["month"], {i: f"fee_{i}" for i in range(1, 13)}, "fee_key", "fee")
    long = stack_frames(
        card.withColumn("payment_form", F.lit(CREDIT_CARD)),
        fees.select("month", F.lit(BOLETO).alias("payment_form"), F.lit(0).alias("fee_key"), F.col("boleto").alias("fee")),
        fees.select("month", F.lit(DEBIT).alias("payment_form"), F.lit(0).alias("fee_key"), F.col("debit").alias("fee")),
    )
    # At most fourteen rows per calendar month, so the same bound as for a month table holds.
    table = month_table(long.groupBy("month", "payment_form", "fee_key").agg(F.min("fee").alias("payment_fee")))
    keyed = base.withColumn(
        "fee_key", F.when(F.col("payment_form") == CREDIT_CARD, F.col("installments")).otherwise(0)
    )
    joined = natural_left(keyed, table, ["month", "payment_form", "fee_key"]).drop("fee_key")
    return joined.withColumn("payment_fee", F.coalesce("payment_fee", F.lit(0)).cast("decimal(18,6)"))


def fees_by_public_id(fraud_by_order: DataFrame) -> DataFrame:
    return fraud_by_order.groupBy("public_id").agg(F.min("fee").alias("order_fee"))


def monthly_fees(base: DataFrame, fraud_by_month: DataFrame, gateway_by_month: DataFrame) -> DataFrame:
    """Fraud fee of the order (`order_fee`), else of the month, for card orders; gateway fee of the month."""
    by_month = monthly(fraud_by_month.withColumnRenamed("fee", "month_fee"), ["month_fee"])
    gateway = monthly(gateway_by_month.withColumnRenamed("fee", "gateway_fee"), ["gateway_fee"])
    joined = natural_left(base, by_month, "month")
    fee = F.when(F.col("payment_form") == CREDIT_CARD, F.coalesce("order_fee", "month_fee"))
    return natural_left(joined.withColumn("fraud_fee", fee), gateway, "month").drop("order_fee", "month_fee")


def fraud_and_gateway(
    base: DataFrame, fraud_by_order: DataFrame, fraud_by_month: DataFrame, gateway_by_month: DataFrame
) -> DataFrame:
    """Fraud fee of the order, else of the month (card orders only); gateway fee of the month."""
    return monthly_fees(natural_left(base, fees_by_public_id(fraud_by_order), "public_id"), fraud_by_month, gateway_by_month)


def packaging_share(base: DataFrame, packaging: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Monthly packaging cost spread evenly over the orders of the month (`base`: one row per order).

    The orders are counted in `orders`, a cheaper frame with the same rows as `base`, if given.
    """
    counts = (base if orders is None else orders).groupBy("month").agg(F.count("order_id").alias("__orders"))
    joined = natural_left(natural_left(base, month_table(counts), "month"), monthly(packaging, ["cost"]), "month")
    return joined.withColumn("packaging", ratio(F.col("cost"), F.col("__orders"))).drop("cost", "__orders")


def fulfilment_share(
    base: DataFrame, fulfilment: DataFrame, production: DataFrame, orders: DataFrame | None = None
) -> DataFrame:
    """Monthly fulfilment and production costs of a unit spread over its orders by revenue (`orders`: as for packaging)."""
    summed = fulfilment.groupBy(*MONTH_UNIT).agg(F.sum("staff").alias("__f_staff"), F.sum("warehouse").alias("__f_warehouse"))
    made = unit_monthly(
        production.withColumnsRenamed({"staff": "__p_staff", "studios": "__p_studios"}), ["__p_staff", "__p_studios"]
    )
    totals = (base if orders is None else orders).groupBy(*MONTH_UNIT).agg(F.sum("revenue").alias("__total"))
    # The three tables have a row per month and unit, so they meet each other before they meet the orders.
    table = natural_left(natural_left(totals, summed, MONTH_UNIT), made, MONTH_UNIT)
    joined = natural_left(base, table, MONTH_UNIT)
    share = share_of_total("revenue", "__total")
    costs = {
        "fulfilment_staff": "__f_staff", "fulfilment_warehouse": "__f_warehouse", "production_staff": "__p_staff",
        "production_studios": "__p_studios",
    }
    return joined.withColumns({out: null_sum(c).cast("double") * share for out, c in costs.items()}).drop(
        *costs.values(), "__total"
    )


def with_carrier_freight(base: DataFrame, erp_invoices: DataFrame, carrier: DataFrame, series_units: dict[int, str]) -> DataFrame:
    """Adds the first invoice of each order and `carrier_freight`, which the carrier's file lists for its number."""
    invoice = first_by(
        erp_invoices, ["public_id", "unit"], ["invoice_id"], ["erp_order_id", "invoice_id", "invoice_number"]
    )
    unit = F.lit(series_units[0])
    for series, name in series_units.items():
        if series:
            unit = F.when(F.col("series") == series, name).otherwise(unit)
    freight = carrier.select(
        unit.alias("unit"), F.replace("invoice_number", F.lit(",00"), F.lit("")).alias("invoice_number"), "freight"
    ).groupBy("unit", "invoice_number").agg(F.min("freight").alias("carrier_freight"))
    return natural_left(natural_left(base, invoice, ["public_id", "unit"]), freight, ["unit", "invoice_number"])


def real_freight(base: DataFrame, erp_invoices: DataFrame, carrier: DataFrame, series_units: dict[int, str]) -> DataFrame:
    """Freight of the carrier's file, found by invoice number, else the shop's shipping cost.

    `series_units` names the unit of an invoice series; its entry 0 is the unit of all others.
    """
    joined = with_carrier_freight(base, erp_invoices, carrier, series_units)
    return joined.withColumn("freight", F.coalesce("carrier_freight", "shipping_cost")).drop("carrier_freight")


# ---------------------------------------------------------------- invoices and exports

BAD_TAX_ID = "erro no cpf"


def invoices(lines: DataFrame) -> DataFrame:
    """Invoice lines of all files without projections (`DI` order numbers), tax id checked."""
    digits = F.substr("tax_id", F.lit(4)).try_cast("long").cast("string")
    return lines.where(~F.col("order_number").contains("DI")).select(
        F.col("order_number").alias("erp_order_id"), F.substr("order_number", F.lit(3)).alias("order_id"),
        money(F.col("invoice_value")).alias("total_value"), money(F.col("goods_value")).alias("basket_value"),
        money(F.col("freight_value")).alias("shipping_value"), parse_day_first("issued_on").alias("invoice_date"),
        "invoice_number", F.when(F.substr("tax_id", F.lit(1), F.lit(3)) != "000", BAD_TAX_ID).otherwise(digits).alias("tax_id"),
        F.col("email").alias("erp_email"),
    )


# Header names of the flat exports.
UTM_HEADERS = {
    "utm_source": "UTM Source", "utm_campaign": "UTM Campaign", "utm_medium": "UTM Medium", "utm_term": "UTM Term",
    "utm_content": "UTM Content", "utm_gclid": "UTM GCLID",
}
ORDER_HEADERS = {
    "order_id": "ID privado", "public_id": "ID público", "created_at": "Data de Criação", "customer_id": "Cliente ID",
    "email": "E-mail", "erp_status": "Status ERP", "payment_status_name": "Status Pagamento",
    "order_value": "Valor Pedido", "items_value": "Valor Itens", "shipping_value": "Valor Frete", **UTM_HEADERS,
    "installments": "Parcelas", "order_state": "Estado Pedido", "payment_method": "Pagamento",
    "credit_card_operator": "Bandeira",
}
ITEM_HEADERS = {
    "order_id": "ID Pedido", "product_code": "Código ERP produto", "product_name": "Nome Produto",
    "variant_code": "Código ERP Variante", "category": "Categoria", "quantity": "Quantidade",
    "unit_price": "Preço Unitário", "total_price": "Preço Total", "campaign_id": "Campanha ID",
    "final_price": "Preço de Venda", "item_id": "Item ID", "campaign_name": "Campanha",
}
USER_HEADERS = {
    "email": "E-mail", "customer_id": "ID", "created_at": "Data de Cadastro", **UTM_HEADERS, "opt_in": "OPT IN",
    "gender": "Sexo", "state": "Estado", "city": "Cidade",
}


def renamed(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    text = {"created_at": F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")} if "created_at" in headers else {}
    return df.select(*[text.get(c, F.col(c)).alias(h) for c, h in headers.items()])


def export_orders(orders_admin: DataFrame) -> DataFrame:
    return renamed(orders_admin, ORDER_HEADERS)


def export_items(items: DataFrame, campaigns: DataFrame) -> DataFrame:
    names = campaigns.select(F.col("id").alias("campaign_id"), F.col("name").alias("campaign_name"))
    return renamed(natural_left(items, names, "campaign_id"), ITEM_HEADERS)


def export_users(customers: DataFrame) -> DataFrame:
    return renamed(customers, USER_HEADERS)
