"""DuckDB restatements of the pipeline rules, for the correctness check.

These are independent SQL restatements of the rules in ``strata.operators``
(not generated from them), over the same feeds (``strata.plans.feeds``).
Conventions shared with ``strata.plans.queries.present``: money and other
decimals are compared as DOUBLE, timestamps as naive TIMESTAMP, and every
window orders with explicit NULLS FIRST / LAST so the two engines' defaults
never matter.
"""

from __future__ import annotations

from strata.plans.feeds import feed_sql

# --- fixed values -----------------------------------------------------------
# Stated here again, not imported: a wrong entry in the library must show.
ACCENTED = "áàãâäéèêëíìîïóòõôöúùûüçÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜÇ"
UNACCENTED = "aaaaaeeeeiiiiooooouuuucAAAAAEEEEIIIIOOOOOUUUUC"
FLAGS = {
    "customers": ("has_null_required_fields",),
    "products": ("has_null_required_fields", "is_valid_record"),
    "orders": ("is_currency_defaulted", "is_total_amount_defaulted", "has_foreign_currency",
               "has_null_required_fields", "has_invalid_values", "is_valid_record"),
    "order_items": ("has_invalid_quantity", "is_valid_item"),
    "shipments": ("is_shipping_cost_defaulted", "has_null_required_fields", "has_invalid_values",
                  "is_valid_record"),
}
# -----------------------------------------------------------------------------


def initcap(x: str) -> str:
    """Spark's initcap (lower everything, upper the first letter after each space)."""
    return (f"list_aggregate(list_transform(string_split({x}, ' '), "
            f"lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ')")


def title_clean(x: str, accents: bool = True) -> str:
    inner = f"translate(trim({x}), '{ACCENTED}', '{UNACCENTED}')" if accents else f"trim({x})"
    return initcap(f"lower({inner})")


def parse_decimal(x: str) -> str:
    return f"TRY_CAST(replace(trim({x}), ',', '.') AS DECIMAL(10, 2))"


def parse_ts(x: str, dmy: bool = False) -> str:
    iso = f"TRY_CAST({x} AS TIMESTAMP)"
    return f"coalesce({iso}, try_strptime({x}, '%d/%m/%Y %H:%M'))" if dmy else iso


def blank(x: str) -> str:
    return f"({x} IS NULL OR trim({x}) = '')"


def newest(rel: str, keys: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
            f"FROM {rel}) WHERE rn = 1")


RECENT = "ingest_date DESC NULLS LAST, ingestion_ts DESC NULLS LAST"


def tie(*cols: str) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


def with_(*ctes: tuple[str, str], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in ctes) + "\n" + final


# --- silver ----------------------------------------------------------------------------------------

def silver_customers_ctes(src: str, p: str = "sc") -> list[tuple[str, str]]:
    typed = (f"SELECT CAST(customer_id AS VARCHAR) AS customer_id, upper(trim(state)) AS state, "
             f"{title_clean('city')} AS city, {parse_ts('created_ts')} AS created_ts, ingestion_ts, "
             f"CAST(ingest_date AS DATE) AS ingest_date FROM {src} WHERE customer_id IS NOT NULL")
    final = (f"SELECT customer_id, CASE WHEN {blank('state')} THEN 'NA' ELSE state END AS state, "
             f"CASE WHEN {blank('city')} THEN 'Unknown' ELSE city END AS city, created_ts, ingestion_ts, ingest_date, "
             f"CASE WHEN customer_id IS NULL OR (state IS NULL AND city IS NULL) THEN true ELSE false END "
             f"AS has_null_required_fields FROM {p}_d")
    return [(f"{p}_t", typed),
            (f"{p}_d", newest(f"{p}_t", "customer_id", f"{RECENT}, {tie('state', 'city', 'created_ts')}")),
            (p, final)]


def silver_products_ctes(src: str, p: str = "sp", dmy: bool = False, strict: bool = False) -> list[tuple[str, str]]:
    typed = (f"SELECT CAST(product_id AS VARCHAR) AS product_id, category, brand, "
             f"{parse_ts('created_ts', dmy)} AS created_ts, ingestion_ts, CAST(ingest_date AS DATE) AS ingest_date "
             f"FROM {src} WHERE product_id IS NOT NULL")
    cleaned = (f"SELECT product_id, CASE WHEN {blank('category')} THEN 'Unknown' ELSE {title_clean('category')} END "
               f"AS category, CASE WHEN {blank('brand')} THEN 'UNKNOWN' ELSE upper(trim(brand)) END AS brand, "
               f"created_ts, CAST(created_ts AS DATE) AS product_created_date, ingestion_ts, ingest_date FROM {p}_d")
    mark = "Unknown" if strict else "UNKNOWN"
    flag = (f"(coalesce(product_id IS NULL, false) OR coalesce(category = '{mark}', false) "
            f"OR coalesce(brand = 'UNKNOWN', false))")
    final = f"SELECT *, {flag} AS has_null_required_fields, NOT {flag} AS is_valid_record FROM {p}_c"
    return [(f"{p}_t", typed),
            (f"{p}_d", newest(f"{p}_t", "product_id", f"{RECENT}, {tie('category', 'brand', 'created_ts')}")),
            (f"{p}_c", cleaned),
            (p, final)]


def silver_orders_ctes(src: str, p: str = "so", dmy: bool = False, strict: bool = False) -> list[tuple[str, str]]:
    t = (lambda c: f"trim({c})") if strict else (lambda c: c)
    currency = f"upper({t('currency')})" if strict else "currency"
    typed = (f"SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, "
             f"{t('status')} AS status, {t('payment_method')} AS payment_method, {currency} AS currency, "
             f"{parse_ts('order_ts', dmy)} AS order_ts, {parse_decimal('total_amount')} AS total_amount, "
             f"ingestion_ts, CAST(ingest_date AS DATE) AS ingest_date FROM {src} WHERE order_id IS NOT NULL")
    order = f"{RECENT}, {tie('customer_id', 'status', 'payment_method', 'currency', 'order_ts', 'total_amount')}"
    cleaned = (f"SELECT order_id, customer_id, "
               f"CASE WHEN status IS NULL THEN 'UNKNOWN' ELSE lower(status) END AS status, "
               f"CASE WHEN payment_method IS NULL THEN 'UNKNOWN' ELSE upper(payment_method) END AS payment_method, "
               f"currency, coalesce(order_ts, CAST(ingest_date AS TIMESTAMP)) AS order_ts, total_amount, "
               f"ingestion_ts, ingest_date FROM {p}_d")
    missing = ("CASE WHEN order_id IS NULL OR customer_id IS NULL OR order_ts IS NULL OR total_amount IS NULL "
               "THEN true ELSE false END")
    invalid = "(total_amount IS NULL OR total_amount < 0)"
    final = (f"SELECT order_id, customer_id, CAST(order_ts AS DATE) AS order_date, order_ts, status, payment_method, "
             f"total_amount, currency, ingestion_ts, ingest_date, currency IS NULL AS is_currency_defaulted, "
             f"total_amount IS NULL AS is_total_amount_defaulted, currency <> 'BRL' AS has_foreign_currency, "
             f"{missing} AS has_null_required_fields, {invalid} AS has_invalid_values, "
             f"NOT (({missing}) OR {invalid}) AS is_valid_record FROM {p}_c")
    return [(f"{p}_t", typed), (f"{p}_d", newest(f"{p}_t", "order_id", order)), (f"{p}_c", cleaned), (p, final)]


def silver_order_items_ctes(src: str, p: str = "si") -> list[tuple[str, str]]:
    typed = (f"SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(product_id AS VARCHAR) AS product_id, "
             f"{parse_decimal('quantity')} AS quantity, {parse_decimal('unit_price')} AS unit_price, "
             f"{parse_decimal('discount_amount')} AS discount_amount, ingestion_ts, "
             f"CAST(ingest_date AS DATE) AS ingest_date FROM {src} "
             f"WHERE order_id IS NOT NULL AND product_id IS NOT NULL")
    order = f"{RECENT}, {tie('quantity', 'unit_price', 'discount_amount')}"
    cleaned = (f"SELECT order_id, product_id, "
               f"CASE WHEN TRY_CAST(floor(quantity) AS INTEGER) < 0 THEN NULL "
               f"ELSE TRY_CAST(floor(quantity) AS INTEGER) END AS quantity, "
               f"CASE WHEN unit_price < 0 THEN NULL ELSE unit_price END AS unit_price, "
               f"CASE WHEN coalesce(discount_amount, 0) < 0 THEN CAST(0 AS DECIMAL(10, 2)) "
               f"ELSE coalesce(discount_amount, CAST(0 AS DECIMAL(10, 2))) END AS discount_amount, "
               f"ingestion_ts, ingest_date FROM {p}_d")
    final = (f"SELECT *, quantity IS NULL AS has_invalid_quantity, "
             f"quantity IS NOT NULL AND unit_price IS NOT NULL AS is_valid_item FROM {p}_c")
    return [(f"{p}_t", typed), (f"{p}_d", newest(f"{p}_t", "order_id, product_id", order)), (f"{p}_c", cleaned),
            (p, final)]


def na(x: str) -> str:
    return f"nullif({x}, 'N/A')"


def silver_shipments_ctes(src: str, p: str = "ss", dmy: bool = False) -> list[tuple[str, str]]:
    typed = (f"SELECT CAST(order_id AS VARCHAR) AS order_id, carrier, delivery_status, "
             f"{parse_ts(na('shipped_ts'), dmy)} AS shipped_ts, "
             f"{parse_ts(na('delivered_ts'), dmy)} AS delivered_ts, "
             f"{parse_decimal('shipping_cost')} AS shipping_cost, ingestion_ts, "
             f"CAST(ingest_date AS DATE) AS ingest_date FROM {src} WHERE order_id IS NOT NULL")
    order = f"{RECENT}, {tie('carrier', 'delivery_status', 'shipped_ts', 'delivered_ts', 'shipping_cost')}"
    cleaned = (f"SELECT order_id, CASE WHEN carrier IS NULL THEN 'Unknown' ELSE {title_clean('carrier', False)} END "
               f"AS carrier, coalesce(shipping_cost, CAST(0 AS DECIMAL(10, 2))) AS shipping_cost, shipped_ts, "
               f"delivered_ts, CASE WHEN delivery_status IS NULL THEN 'unknown' ELSE lower(trim(delivery_status)) END "
               f"AS delivery_status, ingestion_ts, ingest_date, shipping_cost IS NULL AS is_shipping_cost_defaulted "
               f"FROM {p}_d")
    missing = "(order_id IS NULL OR delivery_status IS NULL)"
    final = (f"SELECT *, {missing} AS has_null_required_fields, shipping_cost < 0 AS has_invalid_values, "
             f"NOT ({missing} OR shipping_cost < 0) AS is_valid_record FROM {p}_c")
    return [(f"{p}_t", typed), (f"{p}_d", newest(f"{p}_t", "order_id", order)), (f"{p}_c", cleaned), (p, final)]


# --- gold ------------------------------------------------------------------------------------------

def dim_customers_ctes(src: str, p: str = "dc") -> list[tuple[str, str]]:
    base = (f"SELECT customer_id, state, city, coalesce(created_ts, ingestion_ts) AS created_ts FROM {src} "
            f"WHERE customer_id IS NOT NULL")
    return [(f"{p}_b", base),
            (p, newest(f"{p}_b", "customer_id", f"created_ts DESC NULLS LAST, {tie('state', 'city')}"))]


def dim_products_ctes(src: str, p: str = "dp") -> list[tuple[str, str]]:
    base = (f"SELECT CAST(product_id AS VARCHAR) AS product_id, "
            f"CASE WHEN {blank('category')} THEN 'Unknown' ELSE upper(trim(category)) END AS category, "
            f"CASE WHEN {blank('brand')} THEN 'Unknown' ELSE {initcap('trim(brand)')} END AS brand, "
            f"coalesce(created_ts, ingestion_ts) AS created_ts FROM {src} WHERE product_id IS NOT NULL")
    return [(f"{p}_b", base),
            (p, newest(f"{p}_b", "product_id", f"created_ts DESC NULLS LAST, {tie('category', 'brand')}"))]


def fact_order_items_ctes(src: str, p: str = "fi") -> list[tuple[str, str]]:
    body = (f"SELECT order_id, product_id, quantity, unit_price, discount_amount, "
            f"round(quantity * unit_price - discount_amount, 2) AS item_net_amount FROM ("
            f"SELECT order_id, product_id, quantity, unit_price, "
            f"CASE WHEN discount_amount < 0 THEN CAST(0 AS DECIMAL(10, 2)) ELSE discount_amount END AS discount_amount "
            f"FROM {src} WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND quantity > 0 AND unit_price >= 0)")
    return [(p, body)]


def fact_orders_ctes(orders: str, items: str, ships: str | None, payments: str | None = None,
                     p: str = "fo") -> list[tuple[str, str]]:
    agg = (f"SELECT order_id, sum(quantity * unit_price) AS gross_amount, sum(discount_amount) AS discount_total "
           f"FROM {items} GROUP BY order_id")
    if ships is None:
        ship_cols = ("CAST(NULL AS VARCHAR) AS carrier, CAST(0 AS DECIMAL(10, 2)) AS shipping_cost, "
                     "CAST(NULL AS TIMESTAMP) AS shipped_ts, CAST(NULL AS TIMESTAMP) AS delivered_ts")
        ship_join = ""
    else:
        ship_cols = "s.carrier, s.shipping_cost, s.shipped_ts, s.delivered_ts"
        ship_join = f" LEFT JOIN {ships} s ON o.order_id = s.order_id"
    pay_col, pay_join = "'UNKNOWN' AS payment_method", ""
    if payments is not None:
        pay_col, pay_join = "pm.payment_method", (
            f" LEFT JOIN ({newest(payments, 'order_id', 'ingest_date DESC NULLS LAST, payment_method ASC NULLS LAST')}) pm"
            f" ON o.order_id = pm.order_id")
    joined = (f"SELECT o.order_id, o.customer_id, o.order_ts, round(a.gross_amount, 2) AS gross_amount, "
              f"round(a.discount_total, 2) AS discount_total, {pay_col}, {ship_cols} "
              f"FROM {orders} o LEFT JOIN {p}_a a ON o.order_id = a.order_id{pay_join}{ship_join}")
    hours = ("CASE WHEN shipped_ts IS NOT NULL AND delivered_ts IS NOT NULL THEN "
             "(CAST(epoch(delivered_ts) AS BIGINT) - CAST(epoch(shipped_ts) AS BIGINT)) / 3600 END")
    final = (f"SELECT order_id, customer_id, CAST(order_ts AS DATE) AS order_date, order_ts, gross_amount, "
             f"discount_total, round(coalesce(gross_amount, 0) - coalesce(discount_total, 0) "
             f"+ coalesce(shipping_cost, 0), 2) AS net_amount, payment_method, "
             f"CASE WHEN delivered_ts IS NOT NULL THEN 'DELIVERED' WHEN shipped_ts IS NOT NULL THEN 'SHIPPED' "
             f"ELSE 'CREATED' END AS status_final, carrier, shipping_cost, shipped_ts, delivered_ts, "
             f"{hours} AS delivery_time_hours, {hours} > 72 AS is_late FROM {p}_j")
    return [(f"{p}_a", agg), (f"{p}_j", joined), (p, final)]


def feeds(*names: str) -> list[tuple[str, str]]:
    return [(f"feed_{n}", feed_sql(n)) for n in names]


def as_double(*cols: str) -> str:
    """``SELECT * REPLACE`` list turning decimals into DOUBLE (see ``present``)."""
    return "* REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols) + ")"
