"""The costed order fact: every cost of an order beside its revenue, from tables in order-id buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.joins import natural_left
from basketry.plans import lifecycle, margin

#: Cost columns in the order in which they are added up.
COSTS = [
    "product_cost", "revenue_tax", "product_tax", "freight_tax", "payment_fee", "fraud_fee", "gateway_fee", "packaging",
    "fulfilment_staff", "fulfilment_warehouse", "production_staff", "production_studios", "freight",
]


def recent_heads(heads: DataFrame) -> DataFrame:
    """Orders whose product cost may be computed from their items: since the previous month (see `margin.frozen_order_cost`).

    The cost of older orders comes from the stored history or not at all, so their items need no unit cost.
    """
    return heads.where(F.col("month") >= margin.previous_month(heads))


def product_costs(item_costs: DataFrame) -> DataFrame:
    """Unit costs and quantities by order, all that later stages need of the items."""
    return item_costs.select("order_id", "month", "unit_cost", "quantity")


def order_fraud_fees(heads: DataFrame, fraud_by_order: DataFrame) -> DataFrame:
    """Fraud fees, which come by public id, under the order id."""
    fees = margin.fees_by_public_id(fraud_by_order)
    return heads.select("order_id", "public_id").join(fees, "public_id").select("order_id", "order_fee")


def order_freight(heads: DataFrame, erp_invoices: DataFrame, carrier: DataFrame, series_units: dict[int, str]) -> DataFrame:
    """The carrier's freight of each order with an invoice that the carrier lists."""
    found = margin.with_carrier_freight(heads.select("order_id", "public_id", "unit"), erp_invoices, carrier, series_units)
    return found.where("carrier_freight is not null").select("order_id", "carrier_freight")


def added(columns: list[str]) -> Column:
    """Sum of the columns that are present, from the first to the last."""
    total = F.lit(0.0)
    for column in columns:
        total = total + F.coalesce(F.col(column).cast("double"), F.lit(0.0))
    return total


def order_margin(
    heads: DataFrame, costs: DataFrame, history: DataFrame, fraud: DataFrame, freight: DataFrame, sheets: dict[str, DataFrame]
) -> DataFrame:
    """Orders with all their costs, the sum of them and the margin that revenue leaves.

    The first five are tables with an order id: orders with payment form, `product_costs`, the stored cost history,
    `order_fraud_fees` and `order_freight`. In buckets of that id they are joined as they lie. The month sheets follow, so that no
    shuffle by month comes between; monthly totals are taken from `heads`, not from the joined frame.
    """
    frozen = margin.frozen_order_cost(heads, costs, history)
    joined = natural_left(natural_left(frozen, fraud, "order_id"), freight, "order_id")
    adjusted = margin.shipping_adjust(joined, sheets["shipping_factors"])
    taxed = margin.taxes(adjusted, sheets["tax_rates"])
    paid = margin.payment_fee(taxed, sheets["payment_fees"])
    charged = margin.monthly_fees(paid, sheets["fraud_by_month"], sheets["gateway_by_month"])
    packed = margin.packaging_share(charged, sheets["packaging_by_month"], heads)
    spread = margin.fulfilment_share(packed, sheets["fulfilment_by_month"], sheets["production_by_month"], heads)
    rated = lifecycle.contribution_margin(spread, sheets["margin_by_month"])
    costed = rated.withColumn("freight", F.coalesce("carrier_freight", "shipping_cost")).drop("carrier_freight")
    return costed.withColumn("order_cost", added(COSTS)).withColumn("margin", F.col("revenue").cast("double") - F.col("order_cost"))
