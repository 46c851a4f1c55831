"""Sales metrics over order items, as reusable Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.functions.numbers import ratio, total


def unsold_quantity(cancelled: str = "cancelled_quantity", stockout: str = "stockout_quantity") -> Column:
    return F.col(cancelled) + F.col(stockout)


def liquid_quantity(quantity: str = "quantity") -> Column:
    """Row level: ordered minus cancelled and out of stock."""
    return F.col(quantity) - unsold_quantity()


def basket_value() -> Column:
    return liquid_quantity() * F.col("final_price")


def sales_value() -> Column:
    return basket_value() + F.col("shipping_price")


def gross_quantity_total() -> Column:
    return total(F.col("quantity"))


def liquid_quantity_total() -> Column:
    return total(F.col("quantity")) - (total(F.col("cancelled_quantity")) + total(F.col("stockout_quantity")))


def discount() -> Column:
    """Final price relative to the original price, as a (negative) rate."""
    return ratio(F.col("final_price"), F.col("original_price")) - F.lit(1.0)
