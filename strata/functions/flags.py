"""Data-quality flag builders.

Flags are plain boolean columns.  Where the source rules are three-valued
(a comparison against a null input) the flag is left null on purpose; where
they are wrapped in ``when(cond, True).otherwise(False)`` it is never null.
Each builder documents which.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.fixed import HOME_CURRENCY, MISSING_MARK


def _true_or_false(cond: Column) -> Column:
    """``cond`` with null read as false (``when(cond, True).otherwise(False)``)."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def customer_missing_fields(customer_id: Column, state: Column, city: Column) -> Column:
    """id missing, or state and city both missing.  Never null.

    Tested on the cleaned values *before* defaults are filled in, so a blank
    (non-null) state does not count as missing.
    """
    return _true_or_false(customer_id.isNull() | (state.isNull() & city.isNull()))


def order_flags(
    order_id: Column, customer_id: Column, order_ts: Column, total_amount: Column, currency: Column,
    home_currency: str = HOME_CURRENCY,
) -> dict[str, Column]:
    """Quality flags of a silver order (computed after the timestamp fallback).

    ``has_foreign_currency`` is three-valued: null when the currency is null.
    """
    missing = _true_or_false(
        order_id.isNull() | customer_id.isNull() | order_ts.isNull() | total_amount.isNull()
    )
    invalid = total_amount.isNull() | (total_amount < 0)
    return {
        "is_currency_defaulted": currency.isNull(),
        "is_total_amount_defaulted": total_amount.isNull(),
        "has_foreign_currency": currency != F.lit(home_currency),
        "has_null_required_fields": missing,
        "has_invalid_values": invalid,
        "is_valid_record": ~(missing | invalid),
    }


def item_flags(quantity: Column, unit_price: Column) -> dict[str, Column]:
    """Flags of a silver order line, after the negative-value rules."""
    return {
        "has_invalid_quantity": quantity.isNull(),
        "is_valid_item": quantity.isNotNull() & unit_price.isNotNull(),
    }


def product_flags(product_id: Column, category: Column, brand: Column, missing_mark: str = MISSING_MARK,
                  category_mark: str | None = None) -> dict[str, Column]:
    """A product is flagged when any required field carries a missing mark.

    The category default is ``Unknown`` while the check looks for
    ``UNKNOWN`` (``category_mark`` defaults to ``missing_mark``), so by
    default only the brand can raise the flag; pass the real default
    (``CATEGORY_DEFAULT``) as ``category_mark`` for the strict reading.
    """
    marks = (
        product_id.isNull(),
        category == F.lit(category_mark or missing_mark),
        brand == F.lit(missing_mark),
    )
    flagged = F.lit(False)
    for m in marks:
        flagged = flagged | F.coalesce(m, F.lit(False))
    return {"has_null_required_fields": flagged, "is_valid_record": ~flagged}


def shipment_flags(order_id: Column, delivery_status: Column, shipping_cost: Column) -> dict[str, Column]:
    """Flags of a silver shipment, computed after defaults and cost zeroing."""
    missing = order_id.isNull() | delivery_status.isNull()
    invalid = shipping_cost < 0
    return {
        "has_null_required_fields": missing,
        "has_invalid_values": invalid,
        "is_valid_record": ~(missing | invalid),
    }
