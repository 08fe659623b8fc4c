"""Landing-shaped feeds derived from the benchmark tables.

The benchmark tables are clean and typed; the pipeline expects raw daily
loads (every business column text, plus lineage) with dirt: blanks, case and
accent variants, decimal commas, words in number columns, two timestamp
layouts, sentinels, missing keys and re-sent rows.  Each feed below derives
such a load from a whole table, deterministically, with the dirt placed by
arithmetic on the row's own keys.

Every column is one SQL expression written in the dialect shared by Spark SQL
and DuckDB, so the Spark side (``feed``) and the DuckDB oracle
(``feed_sql``) read exactly the same rows.  A feed with ``copies=2`` is the
whole table sent twice (``UNION ALL``): the second copy lands a day earlier,
the same day or a day later depending on the key, so de-duplication has real
work to do and ties inside a day are broken by the load stamp.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _pad2(expr: str) -> str:
    return f"lpad({_s(expr)}, 2, '0')"


def _day(ts: str) -> str:
    """'yyyy-MM-dd' text of a timestamp column."""
    return _s(f"CAST({ts} AS DATE)")


def _dmy(day: str, hh: str, mi: str) -> str:
    """'dd/MM/yyyy HH:mm' text from a 'yyyy-MM-dd' text."""
    return (f"substr({day}, 9, 2) || '/' || substr({day}, 6, 2) || '/' || substr({day}, 1, 4)"
            f" || ' ' || {hh} || ':' || {mi}")


def _load_day(base: str, key: str, copy: int) -> str:
    """Copy 0 lands on ``base``; copy 1 a day before, the same day or a day after."""
    return base if copy == 0 else f"{base} + CAST(({key} % 3) - 1 AS INT)"


def _load_stamp(day: str, key: str, copy: int) -> str:
    clock = "'06:00:00'" if copy == 0 else f"CASE WHEN {key} % 2 = 0 THEN '03:00:00' ELSE '09:00:00' END"
    return f"CAST({_s(day)} || ' ' || {clock} AS TIMESTAMP)"


def _money(expr: str) -> str:
    """Exact 2-decimal text of a double that already holds cents."""
    return _s(f"CAST({expr} AS DECIMAL(12, 2))")


def _orders(c: int) -> dict[str, str]:
    k = "o_orderkey"
    day = _day("o_orderdate")
    hh, mi, ss = _pad2(f"({k} * 7 + {c}) % 24"), _pad2(f"({k} * 13 + {c} * 5) % 60"), _pad2(f"{k} % 60")
    amount = _money("o_totalprice")
    load = _load_day("CAST(o_orderdate AS DATE)", k, c)
    open_status = "'paid'" if c == 0 else "'Shipped'"
    return {
        "order_id": f"CASE WHEN ({k} + {c}) % 53 = 0 THEN NULL ELSE 'O' || {_s(k)} END",
        "customer_id": f"'C' || {_s('o_custkey')}",
        "order_ts": (f"CASE ({k} + {c}) % 6"
                     f" WHEN 0 THEN {day} || ' ' || {hh} || ':' || {mi} || ':' || {ss}"
                     f" WHEN 1 THEN {day} || 'T' || {hh} || ':' || {mi} || ':' || {ss}"
                     f" WHEN 2 THEN {_dmy(day, hh, mi)}"
                     f" WHEN 3 THEN NULL"
                     f" WHEN 4 THEN {day} || ' ' || {hh} || ':' || {mi} || ':00'"
                     f" ELSE 'not a date' END"),
        "status": (f"CASE WHEN ({k} + 2 * {c}) % 11 = 0 THEN NULL ELSE CASE o_orderstatus"
                   f" WHEN 'F' THEN 'DELIVERED ' WHEN 'O' THEN {open_status}"
                   f" ELSE 'created' END END"),
        "payment_method": (f"CASE WHEN ({k} + {c}) % 13 = 0 THEN NULL ELSE CASE substr(o_orderpriority, 1, 1)"
                           f" WHEN '1' THEN 'pix ' WHEN '2' THEN 'credit_card' WHEN '3' THEN 'BOLETO'"
                           f" WHEN '4' THEN 'Debit_Card' ELSE '' END END"),
        "total_amount": (f"CASE ({k} + {c}) % 10 WHEN 0 THEN replace({amount}, '.', ',')"
                         f" WHEN 1 THEN ' ' || {amount} || ' ' WHEN 2 THEN 'abc' WHEN 3 THEN NULL"
                         f" WHEN 4 THEN '-' || {amount} ELSE {amount} END"),
        "currency": (f"CASE ({k} + {c}) % 9 WHEN 0 THEN NULL WHEN 1 THEN 'USD' WHEN 2 THEN 'brl'"
                     f" WHEN 3 THEN 'BRL ' ELSE 'BRL' END"),
        "ingestion_ts": _load_stamp(load, k, c),
        "ingest_date": load,
        "source_file": f"'orders/ingest_date=' || {_s(load)} || '/orders.csv'",
    }


def _order_items(c: int) -> dict[str, str]:
    ok, ln, pk = "l_orderkey", "l_linenumber", "l_partkey"
    qty = _money("l_quantity")
    price = _money("l_extendedprice")
    disc = _s("CAST(l_discount AS DECIMAL(12, 2)) * 100")
    load = "CAST(l_shipdate AS DATE)"
    return {
        "order_id": f"CASE WHEN ({pk} + {ln}) % 101 = 0 THEN NULL ELSE 'O' || {_s(ok)} END",
        "product_id": f"CASE WHEN ({ok} + {ln}) % 97 = 0 THEN NULL ELSE 'P' || {_s(pk)} END",
        "quantity": (f"CASE ({ok} + {ln}) % 12 WHEN 0 THEN 'two' WHEN 1 THEN NULL WHEN 2 THEN '0'"
                     f" WHEN 3 THEN '-' || {qty} WHEN 4 THEN replace({qty}, '.', ',')"
                     f" WHEN 5 THEN {_money('l_quantity / 4')} ELSE {qty} END"),
        "unit_price": (f"CASE ({ok} * 3 + {ln}) % 10 WHEN 0 THEN 'free' WHEN 1 THEN ' ' || replace({price}, '.', ',')"
                       f" WHEN 2 THEN '-50' WHEN 3 THEN NULL ELSE {price} END"),
        "discount_amount": (f"CASE ({ok} + {ln} * 7) % 9 WHEN 0 THEN 'R$10' WHEN 1 THEN NULL"
                            f" WHEN 2 THEN '-' || {disc} ELSE {disc} END"),
        "ingestion_ts": f"CAST({_s(load)} || ' 05:00:00' AS TIMESTAMP)",
        "ingest_date": load,
        "source_file": f"'order_items/ingest_date=' || {_s(load)} || '/order_items.csv'",
    }


def _shipments(c: int) -> dict[str, str]:
    ok, ln, pk, sk = "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    day = _day("l_shipdate")
    ship_hh = _pad2(f"({ln} * 3) % 24")
    late_day = _s(f"CAST(l_shipdate AS DATE) + CAST({ok} % 9 AS INT)")
    late_hh = _pad2(f"({ok} + {ln} * 5) % 24")
    shipped_iso = f"{day} || ' ' || {ship_hh} || ':15:00'"
    delivered_iso = f"{late_day} || ' ' || {late_hh} || ':45:00'"
    cost = _s("CAST(l_tax AS DECIMAL(12, 2)) * 100")
    load = "CAST(l_shipdate AS DATE)"
    return {
        "order_id": f"CASE WHEN ({ok} + {ln}) % 89 = 0 THEN NULL ELSE 'O' || {_s(ok)} END",
        "carrier": (f"CASE ({sk} + {ln}) % 7 WHEN 0 THEN NULL WHEN 1 THEN 'CORREIOS ' WHEN 2 THEN 'correios  '"
                    f" WHEN 3 THEN 'total express' WHEN 4 THEN ' Jadlog' WHEN 5 THEN '  ' ELSE 'LOGGI' END"),
        "shipping_cost": (f"CASE ({pk} + {ln}) % 8 WHEN 0 THEN replace({cost}, '.', ',') WHEN 1 THEN '-5'"
                          f" WHEN 2 THEN 'free' WHEN 3 THEN NULL ELSE {cost} END"),
        "shipped_ts": (f"CASE ({ok} + {pk}) % 7 WHEN 0 THEN NULL WHEN 1 THEN 'N/A'"
                       f" WHEN 2 THEN {_dmy(day, ship_hh, "'15'")} ELSE {shipped_iso} END"),
        "delivered_ts": (f"CASE ({ok} + {sk}) % 6 WHEN 0 THEN NULL WHEN 1 THEN 'N/A'"
                         f" WHEN 2 THEN {_dmy(late_day, late_hh, "'45'")} ELSE {delivered_iso} END"),
        "delivery_status": (f"CASE ({ok} + {ln}) % 6 WHEN 0 THEN NULL WHEN 1 THEN 'DELIVERED ' WHEN 2 THEN 'in_transit'"
                            f" WHEN 3 THEN 'Lost' WHEN 4 THEN 'returned' ELSE 'label_created' END"),
        "ingestion_ts": f"CAST({_s(load)} || ' ' || {_pad2(ln)} || ':00:00' AS TIMESTAMP)",
        "ingest_date": load,
        "source_file": f"'shipments/ingest_date=' || {_s(load)} || '/shipments.csv'",
    }


def _customers(c: int) -> dict[str, str]:
    k = "c_custkey"
    load = _load_day("DATE '2025-12-01'", k, c)
    return {
        "customer_id": f"CASE WHEN ({k} + {c}) % 71 = 0 THEN NULL ELSE 'C' || {_s(k)} END",
        "state": (f"CASE WHEN ({k} + {c}) % 13 = 0 THEN NULL WHEN ({k} + {c}) % 13 = 1 THEN '  '"
                  f" ELSE CASE n_regionkey WHEN 0 THEN 'sp ' WHEN 1 THEN 'Rj' WHEN 2 THEN 'MG'"
                  f" WHEN 3 THEN ' ba' ELSE 'PR' END END"),
        "city": (f"CASE ({k} + n_nationkey + {c}) % 9 WHEN 0 THEN NULL WHEN 1 THEN ''"
                 f" WHEN 2 THEN 'São Paulo' WHEN 3 THEN 'sao paulo ' WHEN 4 THEN ' RIO DE JANEIRO'"
                 f" WHEN 5 THEN 'belém' WHEN 6 THEN 'Florianópolis' WHEN 7 THEN 'goiânia'"
                 f" ELSE lower(n_name) END"),
        "created_ts": (f"CASE ({k} + {c}) % 5 WHEN 0 THEN NULL WHEN 1 THEN '2024-13-40'"
                       f" ELSE '2024-' || {_pad2(f'{k} % 12 + 1')} || '-' || {_pad2(f'{k} % 28 + 1')}"
                       f" || ' 10:' || {_pad2(f'({k} + {c}) % 60')} || ':00' END"),
        "ingestion_ts": _load_stamp(load, k, c),
        "ingest_date": load,
        "source_file": f"'customers/ingest_date=' || {_s(load)} || '/customers.csv'",
    }


def _products(c: int) -> dict[str, str]:
    k = "p_partkey"
    load = _load_day("DATE '2025-12-01'", k, c)
    mm, dd = _pad2("p_size % 12 + 1"), _pad2(f"{k} % 28 + 1")
    return {
        "product_id": f"CASE WHEN ({k} + {c}) % 61 = 0 THEN NULL ELSE 'P' || {_s(k)} END",
        "category": (f"CASE ({k} + {c}) % 8 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'Eletrônicos'"
                     f" WHEN 3 THEN 'eletronicos ' WHEN 4 THEN 'CASA' ELSE lower(p_type) END"),
        "brand": (f"CASE ({k} * 3 + {c}) % 7 WHEN 0 THEN NULL WHEN 1 THEN ''"
                  f" WHEN 2 THEN lower(p_brand) || ' ' ELSE p_brand END"),
        "created_ts": (f"CASE ({k} + {c}) % 4 WHEN 0 THEN NULL"
                       f" WHEN 1 THEN {dd} || '/' || {mm} || '/2024 08:30'"
                       f" ELSE '2024-' || {mm} || '-' || {dd} || ' 08:30:00' END"),
        "ingestion_ts": _load_stamp(load, k, c),
        "ingest_date": load,
        "source_file": f"'products/ingest_date=' || {_s(load)} || '/products.csv'",
    }


def _payments(c: int) -> dict[str, str]:
    """Every order's payment, and a second one: sent again on a later or earlier
    day with another method, or split on the same day."""
    return {
        "order_id": f"'O' || {_s('o_orderkey')}",
        "payment_method": (f"CASE (o_custkey + {c} * (o_orderkey % 3)) % 5 WHEN 0 THEN 'PIX' WHEN 1 THEN 'CREDIT_CARD' WHEN 2 THEN 'BOLETO'"
                           " WHEN 3 THEN 'DEBIT_CARD' ELSE NULL END"),
        "ingest_date": f"CAST(o_orderdate AS DATE) + CAST({c} * (o_orderkey % 3 - 1) AS INT)",
    }


@dataclass(frozen=True)
class Feed:
    tables: tuple[str, ...]          # first is the driving table; others joined by ``join``
    columns: object                  # copy number -> {name: sql expression}
    copies: int = 1
    join: str | None = None          # equi-join condition for a second table


FEEDS: dict[str, Feed] = {
    "orders": Feed(("orders",), _orders, copies=2),
    "order_items": Feed(("lineitem",), _order_items),
    "shipments": Feed(("lineitem",), _shipments),
    "customers": Feed(("customer", "nation"), _customers, copies=2, join="c_nationkey = n_nationkey"),
    "products": Feed(("part",), _products, copies=2),
    "payments": Feed(("orders",), _payments, copies=2),
}


def feed_columns(name: str) -> list[str]:
    return list(FEEDS[name].columns(0))


def feed_sql(name: str) -> str:
    """The feed as one DuckDB query over the registered benchmark views."""
    f = FEEDS[name]
    source = f.tables[0] if f.join is None else f"{f.tables[0]} JOIN {f.tables[1]} ON {f.join}"
    parts = []
    for c in range(f.copies):
        cols = ", ".join(f"{expr} AS {col}" for col, expr in f.columns(c).items())
        parts.append(f"SELECT {cols} FROM {source}")
    return " UNION ALL ".join(parts)


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def feed(spark: SparkSession, sf_dir: str, name: str, dealt: int | None = None) -> DataFrame:
    """The feed as a Spark frame: one projection of the table per copy.

    A union of plain projections keeps column pruning and short generated
    code; unfolding the copies in one scan by a generator (``inline`` of both,
    or ``explode`` of a copy number under ``CASE`` columns) measured 1.5 to 4
    times slower, as it computes every column or outgrows the compiler's limit.

    ``dealt`` deals the rows of each copy over that many tasks by load day.  The table's
    own narrow columns are sent then, and the feed's texts made where they arrive."""
    f = FEEDS[name]
    src = read_table(spark, sf_dir, f.tables[0])
    if f.join is not None:
        # the dimension side is a fixed-size reference table (25 nations)
        src = src.join(read_table(spark, sf_dir, f.tables[1]), on=_join_cols(f.join), how="inner")
    def copy(c: int) -> DataFrame:
        cols = f.columns(c)
        rows = src if dealt is None else src.repartition(dealt, F.expr(cols["ingest_date"]))
        return rows.selectExpr(*(f"{expr} AS {col}" for col, expr in cols.items()))

    return reduce(DataFrame.unionByName, (copy(c) for c in range(f.copies)))


def _join_cols(cond: str):
    left, right = (s.strip() for s in cond.split("="))
    return F.col(left) == F.col(right)
