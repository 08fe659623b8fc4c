"""Gold stage: the star schema (two dimensions, two facts).

Joins are left equi-joins on ``order_id`` with no hints: adaptive execution
broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold``, and otherwise sort-merges.  The
per-order aggregate leaves its output hash-partitioned by ``order_id``, so
the sort-merge joins that follow reuse that partitioning instead of
shuffling it again.  Every join side is unique per ``order_id`` (silver
orders / shipments are de-duplicated, the aggregate has one row per order, payments
are reduced to one per order), so no key can fan out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import fixed as K
from strata.functions import clean as C
from strata.operators.dedup import latest_by, recency

# --- fixed values: output columns of the gold tables -----------------------------------
DIM_CUSTOMER_COLUMNS = ("customer_id", "state", "city", "created_ts")
DIM_PRODUCT_COLUMNS = ("product_id", "category", "brand", "created_ts")
FACT_ITEM_COLUMNS = ("order_id", "product_id", "quantity", "unit_price", "discount_amount", "item_net_amount")
FACT_ORDER_COLUMNS = ("order_id", "customer_id", "order_date", "order_ts", "gross_amount", "discount_total",
                      "net_amount", "payment_method", "status_final", "carrier", "shipping_cost", "shipped_ts",
                      "delivered_ts", "delivery_time_hours", "is_late")
SHIPMENT_FIELDS = ("carrier", "shipping_cost", "shipped_ts", "delivered_ts")
# -----------------------------------------------------------------------------


def _newest_created(df: DataFrame, key: str, business: tuple[str, ...]) -> DataFrame:
    order = [F.col("created_ts").desc_nulls_last()]
    return latest_by(df, [key], order, tie_break=[c for c in business if c not in (key, "created_ts")])


def dim_customers(silver: DataFrame) -> DataFrame:
    """One row per customer; ``created_ts`` falls back to the ingestion stamp."""
    df = silver.filter(F.col("customer_id").isNotNull()).withColumn(
        "created_ts", C.ts_or_ts("created_ts", "ingestion_ts"))
    return _newest_created(df, "customer_id", DIM_CUSTOMER_COLUMNS).select(*DIM_CUSTOMER_COLUMNS)


def dim_products(silver: DataFrame) -> DataFrame:
    """One row per product: category upper-cased, brand title-cased, both
    defaulted to ``Unknown`` when blank; ``created_ts`` falls back to the
    ingestion stamp."""
    df = silver.filter(F.col("product_id").isNotNull()).withColumns({
        "product_id": F.col("product_id").cast("string"),
        "category": C.default_if_blank("category", K.DIM_TEXT_DEFAULT, then=C.upper_trim),
        "brand": C.default_if_blank("brand", K.DIM_TEXT_DEFAULT, then=lambda c: F.initcap(F.trim(c))),
        "created_ts": C.ts_or_ts("created_ts", "ingestion_ts"),
    })
    return _newest_created(df, "product_id", DIM_PRODUCT_COLUMNS).select(*DIM_PRODUCT_COLUMNS)


def fact_order_items(silver_items: DataFrame) -> DataFrame:
    """Sellable lines (keys present, quantity > 0, price >= 0) with
    ``item_net_amount = round(quantity * unit_price - discount, 2)``.
    The discount is per line, not per unit."""
    zero = C.money_zero()
    df = silver_items.filter(
        F.col("order_id").isNotNull() & F.col("product_id").isNotNull()
        & (F.col("quantity") > 0) & (F.col("unit_price") >= 0)
    ).withColumn("discount_amount", C.zero_if_negative("discount_amount", zero))
    df = df.withColumn(
        "item_net_amount", F.round(F.col("quantity") * F.col("unit_price") - F.col("discount_amount"), 2))
    return df.select(*FACT_ITEM_COLUMNS)


def order_item_totals(items: DataFrame) -> DataFrame:
    """Per order: gross (sum of quantity x price) and total discount.

    A partial aggregate runs before the shuffle, so a hot order costs one
    row per map task on the wire."""
    return items.groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("gross_amount"),
        F.sum("discount_amount").alias("discount_total"),
    )


def one_payment(payments: DataFrame) -> DataFrame:
    """One method per order: of the newest load (``ingest_date``, then
    ``ingestion_ts``, as far as the table has them), a named method before
    a missing one, then the first by name."""
    loads = [c for c in ("ingest_date", "ingestion_ts") if c in payments.columns]
    rows = payments.filter(F.col("order_id").isNotNull()).select("order_id", "payment_method", *loads)
    newest = latest_by(rows, ["order_id"], recency(*loads), tie_break=[F.col("payment_method").asc_nulls_last()])
    return newest.select("order_id", "payment_method")


def fact_orders(
    orders: DataFrame,
    items: DataFrame,
    shipments: DataFrame | None = None,
    payments: DataFrame | None = None,
    payment_source: str = "constant",
    payment_default: str = K.FACT_PAYMENT_DEFAULT,
    valid_only: bool = False,
) -> DataFrame:
    """One row per silver order: money, payment, shipping, delivery time,
    final status and the SLA flag.

    ``items`` are gold order lines.  ``payments`` (order_id, payment_method,
    and perhaps load columns) replaces the order's own method when given, one
    payment per order (see ``one_payment``); otherwise the method is
    ``payment_default`` (``payment_source="orders"`` keeps the order's
    method instead).  ``valid_only`` leaves out orders whose silver row is
    not a valid record.  Without ``shipments`` the shipping columns are typed
    nulls and a zero cost.  Orders with no lines keep null gross/discount.
    """
    if payment_source not in ("constant", "orders"):
        raise ValueError(f"payment_source is 'constant' or 'orders', not {payment_source!r}")
    if valid_only:
        orders = orders.filter("is_valid_record")
    df = orders.join(order_item_totals(items), "order_id", "left")

    if payments is not None:
        df = df.drop("payment_method").join(one_payment(payments), "order_id", "left")
    elif payment_source != "orders":
        df = df.withColumn("payment_method", F.lit(payment_default))

    if shipments is not None:
        df = df.join(shipments.select("order_id", *SHIPMENT_FIELDS), "order_id", "left")
    else:
        df = df.withColumns({
            "carrier": F.lit(None).cast("string"),
            "shipping_cost": C.money_zero(),
            "shipped_ts": F.lit(None).cast("timestamp"),
            "delivered_ts": F.lit(None).cast("timestamp"),
        })

    zero = F.lit(0)
    gross = F.round("gross_amount", 2)
    discount = F.round("discount_total", 2)
    hours = C.hours_between("shipped_ts", "delivered_ts")
    return df.select(
        "order_id",
        "customer_id",
        F.to_date("order_ts").alias("order_date"),
        "order_ts",
        gross.alias("gross_amount"),
        discount.alias("discount_total"),
        F.round(F.coalesce(gross, zero) - F.coalesce(discount, zero) + F.coalesce("shipping_cost", zero), 2)
        .alias("net_amount"),
        "payment_method",
        F.when(F.col("delivered_ts").isNotNull(), K.STATUS_DELIVERED)
        .when(F.col("shipped_ts").isNotNull(), K.STATUS_SHIPPED)
        .otherwise(K.STATUS_CREATED).alias("status_final"),
        "carrier",
        "shipping_cost",
        "shipped_ts",
        "delivered_ts",
        hours.alias("delivery_time_hours"),
        (hours > K.SLA_HOURS).alias("is_late"),
    )
