"""Silver stage: typed, de-duplicated, cleaned and quality-flagged entities.

Each ``silver_*`` function maps a bronze frame (raw text columns plus the
lineage columns ``ingestion_ts``, ``ingest_date``, ``source_file``) to its
silver frame.  The order of steps matters and is part of the contract:
key filter -> typing -> newest row per key -> defaults -> flags -> select.
Flags are computed at the step the rules fix (before or after a default),
so changing the order changes answers.

Plan shape per entity: one scan, one ``Filter`` pushed into it, one
hash exchange on the key (with a map-side top-1), projections.  No
UDFs, no driver work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import fixed as K
from strata.functions import clean as C
from strata.functions import flags as Q
from strata.operators.dedup import latest_by, latest_with_count, recency

# Newest load first: the day of the load, then its stamp.
RECENCY = ("ingest_date", "ingestion_ts")

# --- fixed values: output columns of the silver tables ---------------------------------
CUSTOMER_COLUMNS = ("customer_id", "state", "city", "created_ts", "ingestion_ts", "ingest_date",
                    "has_null_required_fields")
PRODUCT_COLUMNS = ("product_id", "category", "brand", "created_ts", "product_created_date", "ingestion_ts",
                   "ingest_date", "has_null_required_fields", "is_valid_record")
ORDER_COLUMNS = ("order_id", "customer_id", "order_date", "order_ts", "status", "payment_method",
                 "total_amount", "currency", "ingestion_ts", "ingest_date", "is_currency_defaulted",
                 "is_total_amount_defaulted", "has_foreign_currency", "has_null_required_fields",
                 "has_invalid_values", "is_valid_record")
ORDER_ITEM_COLUMNS = ("order_id", "product_id", "quantity", "unit_price", "discount_amount", "ingestion_ts",
                      "ingest_date", "has_invalid_quantity", "is_valid_item")
SHIPMENT_COLUMNS = ("order_id", "carrier", "shipping_cost", "shipped_ts", "delivered_ts", "delivery_status",
                    "ingestion_ts", "ingest_date", "is_shipping_cost_defaulted", "has_null_required_fields",
                    "has_invalid_values", "is_valid_record")
# -----------------------------------------------------------------------------


def _newest(df: DataFrame, keys: Sequence[str], business: Sequence[str], superseded: str | None = None) -> DataFrame:
    """Newest load per key; ties inside one load broken on the typed business columns."""
    ties = [c for c in business if c not in keys]
    if superseded is not None:
        return latest_with_count(df, keys, RECENCY, ties, superseded)
    return latest_by(df, keys, recency(*RECENCY), tie_break=ties)


def silver_customers(bronze: DataFrame) -> DataFrame:
    """Customers: upper-cased state, title-cased unaccented city, one row per id.

    The missing-fields flag is taken before ``state`` / ``city`` defaults
    (``NA`` / ``Unknown``) are filled in.
    """
    df = bronze.filter(F.col("customer_id").isNotNull()).select(
        F.col("customer_id").cast("string").alias("customer_id"),
        C.upper_trim("state").alias("state"),
        C.title_clean("city").alias("city"),
        C.parse_ts("created_ts").alias("created_ts"),
        "ingestion_ts",
        F.col("ingest_date").try_cast("date").alias("ingest_date"),
    )
    df = _newest(df, ["customer_id"], ["state", "city", "created_ts"])
    return df.withColumns({
        "has_null_required_fields": Q.customer_missing_fields(F.col("customer_id"), F.col("state"), F.col("city")),
    }).withColumns({
        "state": C.default_if_blank("state", K.STATE_DEFAULT),
        "city": C.default_if_blank("city", K.CITY_DEFAULT),
    }).select(*CUSTOMER_COLUMNS)


def silver_products(bronze: DataFrame, ts_formats: Sequence[str | None] = (None,), strict: bool = False) -> DataFrame:
    """Products: title-cased category (default ``Unknown``), upper-cased brand
    (default ``UNKNOWN``), creation date, flags.

    By default the flag looks for ``UNKNOWN`` in both fields, so a defaulted
    category never raises it; ``strict=True`` checks the real default.
    """
    df = bronze.filter(F.col("product_id").isNotNull()).select(
        F.col("product_id").cast("string").alias("product_id"),
        F.col("category").cast("string").alias("category"),
        F.col("brand").cast("string").alias("brand"),
        C.parse_ts("created_ts", ts_formats).alias("created_ts"),
        "ingestion_ts",
        F.col("ingest_date").try_cast("date").alias("ingest_date"),
    )
    df = _newest(df, ["product_id"], ["category", "brand", "created_ts"])
    df = df.withColumns({
        "category": C.default_if_blank("category", K.CATEGORY_DEFAULT, then=C.title_clean),
        "brand": C.default_if_blank("brand", K.BRAND_DEFAULT, then=C.upper_trim),
        "product_created_date": F.to_date("created_ts"),
    })
    flags = Q.product_flags(F.col("product_id"), F.col("category"), F.col("brand"),
                            category_mark=K.CATEGORY_DEFAULT if strict else None)
    return df.withColumns(flags).select(*PRODUCT_COLUMNS)


def silver_orders(bronze: DataFrame, ts_formats: Sequence[str | None] = (None,), strict: bool = False,
                  home_currency: str = K.HOME_CURRENCY, lineage: bool = False) -> DataFrame:
    """Orders: parsed timestamp (missing -> midnight of the load day), money,
    lower-cased status and upper-cased payment method (missing -> ``UNKNOWN``),
    and quality flags.

    By default status, payment method and currency keep their edge blanks
    and case (so ``brl`` counts as foreign); ``strict=True`` trims them and
    upper-cases the currency.  ``lineage`` adds the file each row came from
    and the number of rows of its key that it superseded.
    """
    text = (lambda c: F.trim(F.col(c))) if strict else F.col
    df = bronze.filter(F.col("order_id").isNotNull()).select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        text("status").cast("string").alias("status"),
        text("payment_method").cast("string").alias("payment_method"),
        (F.upper(text("currency")) if strict else text("currency")).cast("string").alias("currency"),
        C.parse_ts("order_ts", ts_formats).alias("order_ts"),
        C.parse_decimal("total_amount").alias("total_amount"),
        "ingestion_ts",
        F.col("ingest_date").try_cast("date").alias("ingest_date"),
        *(["source_file"] if lineage else []),
    )
    df = _newest(df, ["order_id"],
                 ["customer_id", "status", "payment_method", "currency", "order_ts", "total_amount"], "superseded" if lineage else None)
    df = df.withColumns({
        "status": C.default_if_null("status", K.ORDER_STATUS_DEFAULT, then=F.lower),
        "payment_method": C.default_if_null("payment_method", K.PAYMENT_DEFAULT, then=F.upper),
        "order_ts": C.ts_or_date("order_ts", "ingest_date"),
    }).withColumn("order_date", F.to_date("order_ts"))
    flags = Q.order_flags(F.col("order_id"), F.col("customer_id"), F.col("order_ts"), F.col("total_amount"),
                          F.col("currency"), home_currency)
    return df.withColumns(flags).select(*ORDER_COLUMNS, *(["source_file", "superseded"] if lineage else []))


def silver_order_items(bronze: DataFrame) -> DataFrame:
    """Order lines, one per (order, product): whole non-negative quantity,
    non-negative price (negative -> null), discount defaulted to 0 and
    floored at 0, and validity flags (taken after those rules)."""
    zero = C.money_zero()
    df = bronze.filter(F.col("order_id").isNotNull() & F.col("product_id").isNotNull()).select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("product_id").cast("string").alias("product_id"),
        C.parse_decimal("quantity").alias("quantity"),
        C.parse_decimal("unit_price").alias("unit_price"),
        C.parse_decimal("discount_amount").alias("discount_amount"),
        "ingestion_ts",
        F.col("ingest_date").try_cast("date").alias("ingest_date"),
    )
    df = _newest(df, ["order_id", "product_id"], ["quantity", "unit_price", "discount_amount"])
    df = df.withColumns({
        "quantity": C.null_if_negative(C.whole_units("quantity")),
        "unit_price": C.null_if_negative("unit_price"),
        "discount_amount": C.zero_if_negative(C.zero_if_null("discount_amount", zero), zero),
    })
    return df.withColumns(Q.item_flags(F.col("quantity"), F.col("unit_price"))).select(*ORDER_ITEM_COLUMNS)


def silver_shipments(bronze: DataFrame, ts_formats: Sequence[str | None] = (None,), sentinel: str = K.NO_VALUE) -> DataFrame:
    """Shipments: sentinel text -> null before parsing, carrier title-cased
    (missing -> ``Unknown``; blank stays blank), status lower-cased (missing
    -> ``unknown``), cost flagged when missing and then zeroed."""
    df = bronze.filter(F.col("order_id").isNotNull()).select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("carrier").cast("string").alias("carrier"),
        F.col("delivery_status").cast("string").alias("delivery_status"),
        C.parse_ts(C.null_if("shipped_ts", sentinel), ts_formats).alias("shipped_ts"),
        C.parse_ts(C.null_if("delivered_ts", sentinel), ts_formats).alias("delivered_ts"),
        C.parse_decimal("shipping_cost").alias("shipping_cost"),
        "ingestion_ts",
        F.col("ingest_date").try_cast("date").alias("ingest_date"),
    )
    df = _newest(df, ["order_id"], ["carrier", "delivery_status", "shipped_ts", "delivered_ts", "shipping_cost"])
    df = df.withColumns({
        "carrier": C.default_if_null("carrier", K.CARRIER_DEFAULT, then=lambda c: C.title_clean(c, accents=False)),
        "delivery_status": C.default_if_null("delivery_status", K.DELIVERY_STATUS_DEFAULT,
                                            then=lambda c: F.lower(F.trim(c))),
        "is_shipping_cost_defaulted": F.col("shipping_cost").isNull(),
    }).withColumn("shipping_cost", C.zero_if_null("shipping_cost", C.money_zero()))
    flags = Q.shipment_flags(F.col("order_id"), F.col("delivery_status"), F.col("shipping_cost"))
    return df.withColumns(flags).select(*SHIPMENT_COLUMNS)
