"""Named queries over the benchmark tables, and their DuckDB oracles.

Each query reads whole tables through ``strata.plans.feeds`` and runs the
library's operators on them.  ``present`` fixes the comparison types: money
and other decimals as double, timestamps as zone-free timestamps (wall-clock
in the session zone), so the result compares value-for-value with the SQL in
``ORACLE``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from strata import fixed as K
from strata.functions import clean as C
from strata.operators import audit, gold, silver
from strata.operators.inspect import preview
from strata.operators.dedup import latest_by, recency
from strata.plans import incremental
from strata.plans import oracle as O
from strata.plans.feeds import FEEDS, feed, feed_sql
from strata.plans.feeds import read_table as feed_table
from strata.session import scratch_path
from strata.sinks.writers import CODEC, DIRECT_COMMIT, export_csv, write_bucketed, write_table
from strata.plans.pipeline import Lake, fan_out, run_bronze, run_gold, run_pipeline, run_silver, run_silver_observed
from strata.sources.contracts import CONTRACTS, all_text, business_columns, conform, write_conformed
from strata.sources.landing import header_drift, ingest_audit, ingest_entity, lineage_audit
from strata.sources.tables import footer_counts, read_table
from strata.streaming.incremental import drain, start_incremental_ingest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Decimals -> double, zoned timestamps -> wall-clock timestamps."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: present(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- shared building blocks ------------------------------------------------------------------------

def orders_silver(spark, sf, **kw):
    return silver.silver_orders(feed(spark, sf, "orders"), **kw)


def items_silver(spark, sf):
    return silver.silver_order_items(feed(spark, sf, "order_items"))


def shipments_silver(spark, sf, **kw):
    return silver.silver_shipments(feed(spark, sf, "shipments"), **kw)


def items_gold(spark, sf):
    return gold.fact_order_items(items_silver(spark, sf))


_MONEY_FACT = ("gross_amount", "discount_total", "net_amount", "shipping_cost")
_FACT_CTES = (O.feeds("orders", "order_items", "shipments")
              + O.silver_orders_ctes("feed_orders") + O.silver_order_items_ctes("feed_order_items")
              + O.fact_order_items_ctes("si") + O.silver_shipments_ctes("feed_shipments"))


# --- gold ------------------------------------------------------------------------------------------

@register("fact_orders", O.with_(*_FACT_CTES, *O.fact_orders_ctes("so", "fi", "ss"),
                                 final=f"SELECT {O.as_double(*_MONEY_FACT)} FROM fo"))
def q_fact_orders(spark, sf):
    return gold.fact_orders(orders_silver(spark, sf), items_gold(spark, sf), shipments_silver(spark, sf))


@register("fact_orders_no_shipments", O.with_(*_FACT_CTES, *O.fact_orders_ctes("so", "fi", None),
                                              final=f"SELECT {O.as_double(*_MONEY_FACT)} FROM fo"))
def q_fact_orders_no_shipments(spark, sf):
    return gold.fact_orders(orders_silver(spark, sf), items_gold(spark, sf))


@register("fact_orders_with_payments",
          O.with_(*_FACT_CTES, *O.feeds("payments"), *O.fact_orders_ctes("so", "fi", "ss", "feed_payments"),
                  final=f"SELECT {O.as_double(*_MONEY_FACT)} FROM fo"))
def q_fact_orders_with_payments(spark, sf):
    return gold.fact_orders(orders_silver(spark, sf), items_gold(spark, sf), shipments_silver(spark, sf),
                            payments=feed(spark, sf, "payments"))


@register("fact_order_items",
          O.with_(*O.feeds("order_items"), *O.silver_order_items_ctes("feed_order_items"),
                  *O.fact_order_items_ctes("si"),
                  final=f"SELECT {O.as_double('unit_price', 'discount_amount', 'item_net_amount')} FROM fi"))
def q_fact_order_items(spark, sf):
    return items_gold(spark, sf)


@register("dim_customers", O.with_(*O.feeds("customers"), *O.silver_customers_ctes("feed_customers"),
                                   *O.dim_customers_ctes("sc"), final="SELECT * FROM dc"))
def q_dim_customers(spark, sf):
    return gold.dim_customers(silver.silver_customers(feed(spark, sf, "customers")))


@register("dim_products", O.with_(*O.feeds("products"), *O.silver_products_ctes("feed_products"),
                                  *O.dim_products_ctes("sp"), final="SELECT * FROM dp"))
def q_dim_products(spark, sf):
    return gold.dim_products(silver.silver_products(feed(spark, sf, "products")))


# --- silver ----------------------------------------------------------------------------------------

@register("silver_customers", O.with_(*O.feeds("customers"), *O.silver_customers_ctes("feed_customers"),
                                      final="SELECT * FROM sc"))
def q_silver_customers(spark, sf):
    return silver.silver_customers(feed(spark, sf, "customers"))


@register("silver_products", O.with_(*O.feeds("products"), *O.silver_products_ctes("feed_products"),
                                     final="SELECT * FROM sp"))
def q_silver_products(spark, sf):
    return silver.silver_products(feed(spark, sf, "products"))


@register("silver_products_strict",
          O.with_(*O.feeds("products"), *O.silver_products_ctes("feed_products", dmy=True, strict=True),
                  final="SELECT * FROM sp"))
def q_silver_products_strict(spark, sf):
    return silver.silver_products(feed(spark, sf, "products"), ts_formats=(None, C.DMY_MINUTES), strict=True)


@register("silver_orders", O.with_(*O.feeds("orders"), *O.silver_orders_ctes("feed_orders"),
                                   final=f"SELECT {O.as_double('total_amount')} FROM so"))
def q_silver_orders(spark, sf):
    return orders_silver(spark, sf)


@register("silver_orders_strict",
          O.with_(*O.feeds("orders"), *O.silver_orders_ctes("feed_orders", dmy=True, strict=True),
                  final=f"SELECT {O.as_double('total_amount')} FROM so"))
def q_silver_orders_strict(spark, sf):
    return orders_silver(spark, sf, ts_formats=(None, C.DMY_MINUTES), strict=True)


@register("silver_order_items",
          O.with_(*O.feeds("order_items"), *O.silver_order_items_ctes("feed_order_items"),
                  final=f"SELECT {O.as_double('unit_price', 'discount_amount')} FROM si"))
def q_silver_order_items(spark, sf):
    return items_silver(spark, sf)


@register("silver_shipments", O.with_(*O.feeds("shipments"), *O.silver_shipments_ctes("feed_shipments"),
                                      final=f"SELECT {O.as_double('shipping_cost')} FROM ss"))
def q_silver_shipments(spark, sf):
    return shipments_silver(spark, sf)


@register("silver_shipments_multi_format",
          O.with_(*O.feeds("shipments"), *O.silver_shipments_ctes("feed_shipments", dmy=True),
                  final=f"SELECT {O.as_double('shipping_cost')} FROM ss"))
def q_silver_shipments_multi_format(spark, sf):
    return shipments_silver(spark, sf, ts_formats=(None, C.DMY_MINUTES))


# --- column builders -------------------------------------------------------------------------------

def _feed_sql(name: str, select: str) -> str:
    return O.with_(*O.feeds(name), final=f"SELECT {select} FROM feed_{name}")


@register("parse_decimal", _feed_sql(
    "order_items",
    "order_id, product_id, ingest_date, quantity AS quantity_raw, unit_price AS unit_price_raw, "
    "discount_amount AS discount_raw, "
    f"CAST({O.parse_decimal('quantity')} AS DOUBLE) AS quantity, "
    f"CAST({O.parse_decimal('unit_price')} AS DOUBLE) AS unit_price, "
    f"CAST({O.parse_decimal('discount_amount')} AS DOUBLE) AS discount_amount"))
def q_parse_decimal(spark, sf):
    return feed(spark, sf, "order_items").select(
        "order_id", "product_id", "ingest_date",
        F.col("quantity").alias("quantity_raw"), F.col("unit_price").alias("unit_price_raw"),
        F.col("discount_amount").alias("discount_raw"),
        C.parse_decimal("quantity").alias("quantity"), C.parse_decimal("unit_price").alias("unit_price"),
        C.parse_decimal("discount_amount").alias("discount_amount"))


@register("parse_timestamp_multi", _feed_sql(
    "orders",
    "order_id, ingest_date, order_ts AS order_ts_raw, "
    f"{O.parse_ts('order_ts')} AS order_ts_iso, {O.parse_ts('order_ts', dmy=True)} AS order_ts_any"))
def q_parse_timestamp_multi(spark, sf):
    return feed(spark, sf, "orders").select(
        "order_id", "ingest_date", F.col("order_ts").alias("order_ts_raw"),
        C.parse_ts("order_ts").alias("order_ts_iso"),
        C.parse_ts("order_ts", (None, C.DMY_MINUTES)).alias("order_ts_any"))


@register("null_sentinel", _feed_sql(
    "shipments",
    "order_id, ingest_date, delivered_ts AS delivered_raw, nullif(delivered_ts, 'N/A') AS delivered_text, "
    f"{O.parse_ts(O.na('delivered_ts'), dmy=True)} AS delivered_ts"))
def q_null_sentinel(spark, sf):
    return feed(spark, sf, "shipments").select(
        "order_id", "ingest_date", F.col("delivered_ts").alias("delivered_raw"),
        C.null_if("delivered_ts", K.NO_VALUE).alias("delivered_text"),
        C.parse_ts(C.null_if("delivered_ts", K.NO_VALUE), (None, C.DMY_MINUTES)).alias("delivered_ts"))


@register("text_normalize", _feed_sql(
    "customers",
    "customer_id, ingest_date, city AS city_raw, "
    f"translate(city, '{C.ACCENTED}', '{C.UNACCENTED}') AS city_plain, {O.title_clean('city')} AS city_title, "
    f"{O.title_clean('city', False)} AS city_title_accented, upper(trim(state)) AS state_code"))
def q_text_normalize(spark, sf):
    return feed(spark, sf, "customers").select(
        "customer_id", "ingest_date", F.col("city").alias("city_raw"),
        C.strip_accents("city").alias("city_plain"), C.title_clean("city").alias("city_title"),
        C.title_clean("city", accents=False).alias("city_title_accented"), C.upper_trim("state").alias("state_code"))


@register("default_blank", _feed_sql(
    "customers",
    "customer_id, ingest_date, "
    f"CASE WHEN {O.blank('state')} THEN 'NA' ELSE state END AS state_or_na, "
    "CASE WHEN city IS NULL THEN 'Unknown' ELSE city END AS city_or_unknown, "
    f"CASE WHEN {O.blank('city')} THEN 'Unknown' ELSE {O.title_clean('city')} END AS city_clean"))
def q_default_blank(spark, sf):
    return feed(spark, sf, "customers").select(
        "customer_id", "ingest_date",
        C.default_if_blank("state", K.STATE_DEFAULT).alias("state_or_na"),
        C.default_if_null("city", K.CITY_DEFAULT).alias("city_or_unknown"),
        C.default_if_blank("city", K.CITY_DEFAULT, then=C.title_clean).alias("city_clean"))


@register("negative_rules", O.with_(
    ("a", "SELECT c_custkey, CAST(c_acctbal AS DECIMAL(12, 2)) AS acct FROM customer"),
    final="SELECT c_custkey, CAST(acct AS DOUBLE) AS acct, "
          "CAST(CASE WHEN acct < 0 THEN NULL ELSE acct END AS DOUBLE) AS acct_nonneg, "
          "CAST(CASE WHEN acct < 0 THEN 0 ELSE acct END AS DOUBLE) AS acct_floor0, "
          "CAST(coalesce(CASE WHEN acct < 0 THEN NULL ELSE acct END, 0) AS DOUBLE) AS acct_nonneg_or_zero "
          "FROM a"))
def q_negative_rules(spark, sf):
    zero = C.money_zero(DecimalType(12, 2))
    acct = F.col("c_acctbal").cast(DecimalType(12, 2))
    return feed_table(spark, sf, "customer").select(
        "c_custkey", acct.alias("acct"), C.null_if_negative(acct).alias("acct_nonneg"),
        C.zero_if_negative(acct, zero).alias("acct_floor0"),
        C.zero_if_null(C.null_if_negative(acct), zero).alias("acct_nonneg_or_zero"))


@register("whole_units", _feed_sql(
    "order_items",
    "order_id, product_id, ingest_date, quantity AS quantity_raw, "
    f"TRY_CAST(floor({O.parse_decimal('quantity')}) AS INTEGER) AS units"))
def q_whole_units(spark, sf):
    return feed(spark, sf, "order_items").select(
        "order_id", "product_id", "ingest_date", F.col("quantity").alias("quantity_raw"),
        C.whole_units(C.parse_decimal("quantity")).alias("units"))


@register("timestamp_fallback", _feed_sql(
    "orders",
    "order_id, ingest_date, order_ts AS order_ts_raw, "
    f"coalesce({O.parse_ts('order_ts')}, CAST(ingest_date AS TIMESTAMP)) AS order_ts"))
def q_timestamp_fallback(spark, sf):
    return feed(spark, sf, "orders").select(
        "order_id", "ingest_date", F.col("order_ts").alias("order_ts_raw"),
        C.ts_or_date(C.parse_ts("order_ts"), "ingest_date").alias("order_ts"))


@register("created_fallback", _feed_sql(
    "customers",
    f"customer_id, ingest_date, coalesce({O.parse_ts('created_ts')}, ingestion_ts) AS created_ts"))
def q_created_fallback(spark, sf):
    return feed(spark, sf, "customers").select(
        "customer_id", "ingest_date", C.ts_or_ts(C.parse_ts("created_ts"), "ingestion_ts").alias("created_ts"))


# --- de-duplication --------------------------------------------------------------------------------

@register("latest_per_key", O.with_(("e", O.newest(
    "events", "user_id",
    f"ts DESC NULLS LAST, {O.tie('event_id', 'ts', 'event_type', 'value', 'props')}")), final="SELECT * FROM e"))
def q_latest_per_key(spark, sf):
    return latest_by(feed_table(spark, sf, "events"), ["user_id"], recency("ts"))


_LI_REST = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
            "l_linestatus", "l_shipdate")


@register("latest_per_composite_key", O.with_(("l", O.newest(
    "lineitem", "l_orderkey, l_linenumber", f"l_shipdate DESC NULLS LAST, {O.tie(*_LI_REST)}")),
    final="SELECT * FROM l"))
def q_latest_per_composite_key(spark, sf):
    return latest_by(feed_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], recency("l_shipdate"))


# --- quality and audits ----------------------------------------------------------------------------

_ORDER_FLAGS = audit.SILVER_FLAGS["orders"]


@register("order_quality_flags", O.with_(
    *O.feeds("orders"), *O.silver_orders_ctes("feed_orders"),
    final=f"SELECT {', '.join(O.FLAGS['orders'])}, count(*) AS rows FROM so GROUP BY ALL"))
def q_order_quality_flags(spark, sf):
    return audit.flag_profile(orders_silver(spark, sf), _ORDER_FLAGS)


def _summary_sql() -> str:
    rels = {"customers": "sc", "products": "sp", "orders": "so", "order_items": "si", "shipments": "ss"}
    parts = []
    for table, rel in rels.items():
        parts.append(f"SELECT '{table}' AS table_name, 'rows' AS measure, count(*) AS value FROM {rel}")
        for flag in O.FLAGS[table]:
            parts.append(f"SELECT '{table}', '{flag}', CAST(count_if({flag}) AS BIGINT) FROM {rel}")
    ctes = (O.feeds("customers", "products", "orders", "order_items", "shipments")
            + O.silver_customers_ctes("feed_customers") + O.silver_products_ctes("feed_products")
            + O.silver_orders_ctes("feed_orders") + O.silver_order_items_ctes("feed_order_items")
            + O.silver_shipments_ctes("feed_shipments"))
    return O.with_(*ctes, final=" UNION ALL ".join(parts))


@register("quality_summary", _summary_sql())
def q_quality_summary(spark, sf):
    return audit.quality_summary({
        "customers": silver.silver_customers(feed(spark, sf, "customers")),
        "products": silver.silver_products(feed(spark, sf, "products")),
        "orders": orders_silver(spark, sf),
        "order_items": items_silver(spark, sf),
        "shipments": shipments_silver(spark, sf),
    })


@register("orphan_audit", O.with_(
    *O.feeds("orders", "order_items"), *O.silver_orders_ctes("feed_orders"),
    *O.silver_order_items_ctes("feed_order_items"),
    ("p", "SELECT DISTINCT order_id FROM so WHERE order_id IS NOT NULL"),
    ("c", "SELECT order_id, count(*) AS n FROM si WHERE order_id IS NOT NULL GROUP BY order_id"),
    final="SELECT CAST(coalesce(sum(CASE WHEN p.order_id IS NULL THEN c.n END), 0) AS BIGINT) AS orphan_rows, "
          "CAST(count_if(p.order_id IS NULL) AS BIGINT) AS orphan_keys, "
          "CAST(count_if(c.order_id IS NULL) AS BIGINT) AS parents_without_children "
          "FROM p FULL OUTER JOIN c ON p.order_id = c.order_id"))
def q_orphan_audit(spark, sf):
    return audit.orphan_audit(orders_silver(spark, sf), items_silver(spark, sf))


@register("orders_preview", O.with_(*O.feeds("orders"), *O.silver_orders_ctes("feed_orders"),
                                    final=f"SELECT {O.as_double('total_amount')} FROM so ORDER BY order_id LIMIT 130"))
def q_orders_preview(spark, sf):
    return preview(orders_silver(spark, sf), ["order_id"], 130)


@register("ingest_audit",
          "SELECT CAST(ts AS DATE) AS ingest_date, count(*) AS rows FROM events GROUP BY 1 ORDER BY 1")
def q_ingest_audit(spark, sf):
    return ingest_audit(feed_table(spark, sf, "events").withColumn("ingest_date", F.to_date("ts")))


_ENTITIES = ("customers", "products", "orders", "order_items", "shipments")


@register("bronze_rows_per_day", O.with_(
    *O.feeds(*_ENTITIES),
    final=" UNION ALL ".join(f"SELECT '{e}' AS table_name, CAST(ingest_date AS DATE) AS ingest_date, count(*) AS rows "
                             f"FROM feed_{e} GROUP BY 2" for e in _ENTITIES)))
def q_bronze_rows_per_day(spark, sf):
    """Rows per load day of every landing feed (the ingest audit of each bronze table)."""
    parts = [ingest_audit(feed(spark, sf, e), sort=False).select(F.lit(e).alias("table_name"), "ingest_date", "rows")
             for e in _ENTITIES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _gold_counts_sql() -> str:
    ctes = (O.feeds("customers", "products", "orders", "order_items", "shipments")
            + O.silver_customers_ctes("feed_customers") + O.dim_customers_ctes("sc")
            + O.silver_products_ctes("feed_products") + O.dim_products_ctes("sp")
            + O.silver_orders_ctes("feed_orders") + O.silver_order_items_ctes("feed_order_items")
            + O.fact_order_items_ctes("si") + O.silver_shipments_ctes("feed_shipments")
            + O.fact_orders_ctes("so", "fi", "ss"))
    rels = {"dim_customers": "dc", "dim_products": "dp", "fact_order_items": "fi", "fact_orders": "fo"}
    return O.with_(*ctes, final=" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows FROM {r}" for t, r in rels.items()))


@register("gold_row_counts", _gold_counts_sql())
def q_gold_row_counts(spark, sf):
    """Row count of each gold table (one global count per table)."""
    items = items_gold(spark, sf)
    tables = {
        "dim_customers": gold.dim_customers(silver.silver_customers(feed(spark, sf, "customers"))),
        "dim_products": gold.dim_products(silver.silver_products(feed(spark, sf, "products"))),
        "fact_order_items": items,
        "fact_orders": gold.fact_orders(orders_silver(spark, sf), items, shipments_silver(spark, sf)),
    }
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows")
             for t, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- sources and sinks -----------------------------------------------------------------------------

_CUSTOMER_LANDING = ("customer_id", "state", "city", "created_ts")
# A landing CSV has no way to tell an empty field from a missing one, and the
# landing contract reads both as null; so after the trip through CSV an empty
# text value is expected back as null.
_LANDING_SQL = _feed_sql("customers", ", ".join(f"nullif({c}, '') AS {c}" for c in _CUSTOMER_LANDING)
                         + ", ingest_date")


_DROPS = "{entity}/ingest_date=*/part-*"


def landing_tasks(spark: SparkSession) -> int:
    """Tasks that landing drops are dealt over: every slot has days to write, and a large feed is
    sorted in as many parts as the session's shuffles have, not in one part a slot, however long."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def write_landing(df: DataFrame, root: str, entity: str, mode: str = "overwrite", dealt: bool = False) -> None:
    """Write a feed as landing CSV drops ``<root>/<entity>/ingest_date=<d>/``, gzipped
    (text kept exactly: no edge trimming).  Rows are dealt over the tasks by load
    day first (unless ``dealt`` already), so a load is one file, as a landing zone holds them, or a file per million rows."""
    rows = df if dealt else df.repartition(landing_tasks(df.sparkSession), "ingest_date")
    (rows.write.mode(mode).option("header", True).option(*DIRECT_COMMIT).option("compression", "gzip").option("maxRecordsPerFile", 1_000_000)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .partitionBy("ingest_date").csv(f"{root}/{entity}"))


@register("bronze_roundtrip", _LANDING_SQL)
def q_bronze_roundtrip(spark, sf):
    """Feed -> landing CSV -> bronze, loaded twice: the second load replaces
    its days, so every landed row is in bronze exactly once."""
    root = scratch_path(spark, "bronze-roundtrip")
    write_landing(feed(spark, sf, "customers").select(*_CUSTOMER_LANDING, "ingest_date"), f"{root}/landing",
                  "customers")
    for _ in range(2):
        ingest_entity(spark, f"{root}/landing", f"{root}/bronze/customers", "customers",
                      pattern=_DROPS, cluster=True)
    return read_table(spark, f"{root}/bronze/customers").select(*_CUSTOMER_LANDING, "ingest_date")


@register("stream_bronze_roundtrip", _LANDING_SQL)
def q_stream_bronze_roundtrip(spark, sf):
    """Feed -> landing CSV -> bronze through the incremental stream, run
    twice: the second run finds no new file, so nothing is loaded twice."""
    root = scratch_path(spark, "stream-roundtrip")
    write_landing(feed(spark, sf, "customers").select(*_CUSTOMER_LANDING, "ingest_date"), f"{root}/landing",
                  "customers")
    for _ in range(2):
        drain(start_incremental_ingest(spark, f"{root}/landing/customers", f"{root}/bronze/customers",
                                       f"{root}/checkpoints/customers", _CUSTOMER_LANDING))
    return read_table(spark, f"{root}/bronze/customers").select(*_CUSTOMER_LANDING, "ingest_date")


@register("csv_export_roundtrip", O.with_(*O.feeds("products"), *O.silver_products_ctes("feed_products"),
                                          final="SELECT * FROM sp"))
def q_csv_export_roundtrip(spark, sf):
    """Silver products -> ';' extract with header -> read back and conformed
    to the silver schema: the extract loses nothing."""
    table = silver.silver_products(feed(spark, sf, "products"))
    path = scratch_path(spark, "csv-export")
    export_csv(table, path)
    back = (spark.read.option("header", True).option("delimiter", ";")
            .schema(all_text(table.columns)).csv(path))
    return conform(back, table.schema)


@register("contract_conform", _feed_sql(
    "orders",
    "order_id, customer_id, TRY_CAST(order_ts AS TIMESTAMP) AS order_ts, status, payment_method, "
    "CAST(TRY_CAST(total_amount AS DECIMAL(10, 2)) AS DOUBLE) AS total_amount, currency, ingestion_ts, "
    "CAST(ingest_date AS VARCHAR) AS ingest_date, source_file"))
def q_contract_conform(spark, sf):
    return conform(feed(spark, sf, "orders"), CONTRACTS["orders"])


# --- end to end ------------------------------------------------------------------------------------

# Bronze stamps one ``ingestion_ts`` per load, so inside a load the stamp
# never decides a tie; any constant stands for it in the oracle.
_LOAD_STAMP = "TIMESTAMP '2000-01-01 00:00:00'"


def _landed(entity: str) -> str:
    """A feed after its trip through landing CSVs: empty text reads as null, one stamp for the load."""
    cols = ", ".join(f"nullif({c}, '') AS {c}" for c in business_columns(entity))
    return f"SELECT {cols}, CAST(ingest_date AS DATE) AS ingest_date, {_LOAD_STAMP} AS ingestion_ts FROM ({feed_sql(entity)}) f"


def land_drops(spark: SparkSession, sf: str, root: str, entity: str) -> None:
    """An entity's feed as daily CSV drops; from the middle of the period on
    with a column more in the middle of the header, as real feeds grow."""
    names = business_columns(entity)
    days = feed(spark, sf, entity).select("ingest_date")
    middle = days.agg(F.percentile_approx(F.unix_date(F.col("ingest_date").cast("date")), 0.5).alias("d")).first()["d"]
    late = F.unix_date(F.col("ingest_date").cast("date")) >= middle
    # a table sent once has a file per day also if its own columns are dealt, which are half as wide as the texts;
    # of a table sent twice, each copy would leave one
    once = FEEDS[entity].copies == 1
    landed = feed(spark, sf, entity, dealt=landing_tasks(spark) if once else None).select(*names, "ingest_date")
    write_landing(landed.filter(~late), root, entity, dealt=once)
    grown = landed.filter(late).select(*names[:1], F.lit("v2").alias("feed_version"), *names[1:], "ingest_date")
    write_landing(grown, root, entity, mode="append", dealt=once)


def _end_to_end_lake(spark: SparkSession, sf: str) -> Lake:
    """Landing CSVs -> bronze -> silver -> gold over all entities, as separate
    jobs, each layer written and read back.  The four end-to-end queries read
    the tables of one run per session and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        root = scratch_path(spark, "end-to-end")
        fan_out({e: (lambda e=e: land_drops(spark, sf, f"{root}/landing", e)) for e in _ENTITIES}, parallel=True)
        _RUNS[key] = run_pipeline(spark, f"{root}/landing", f"{root}/lake", pattern=_DROPS, cluster=True)
    return _RUNS[key]


_RUNS: dict[tuple[str, str], Lake] = {}
_LANDED = [(f"land_{e}", _landed(e)) for e in _ENTITIES]


def _gold_as_written(table: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return read_table(spark, _end_to_end_lake(spark, sf).path("gold", table), merge_schema=False)
    return query


# a missing creation stamp falls back to the load's, which no oracle can know
_KNOWN_STAMP = f"CASE WHEN created_ts <> {_LOAD_STAMP} THEN created_ts END AS created_ts"


def _known_stamp(query):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = query(spark, sf)
        day_before = F.date_sub(F.current_date(), 1)  # the feeds' stamps are years old, the load's is of now
        return df.withColumn("created_ts", F.when(F.col("created_ts") < day_before, F.col("created_ts")))
    return run


register("end_to_end_dim_customers", O.with_(
    *_LANDED, *O.silver_customers_ctes("land_customers"), *O.dim_customers_ctes("sc"),
    final=f"SELECT * REPLACE ({_KNOWN_STAMP}) FROM dc"))(_known_stamp(_gold_as_written("dim_customers")))
register("end_to_end_dim_products", O.with_(
    *_LANDED, *O.silver_products_ctes("land_products"), *O.dim_products_ctes("sp"),
    final=f"SELECT * REPLACE ({_KNOWN_STAMP}) FROM dp"))(_known_stamp(_gold_as_written("dim_products")))
register("end_to_end_fact_order_items", O.with_(
    *_LANDED, *O.silver_order_items_ctes("land_order_items"), *O.fact_order_items_ctes("si"),
    final=f"SELECT {O.as_double('unit_price', 'discount_amount', 'item_net_amount')} FROM fi"))(_gold_as_written("fact_order_items"))
register("end_to_end_fact_orders", O.with_(
    *_LANDED, *O.silver_orders_ctes("land_orders"), *O.silver_order_items_ctes("land_order_items"), *O.fact_order_items_ctes("si"),
    *O.silver_shipments_ctes("land_shipments"), *O.fact_orders_ctes("so", "fi", "ss"),
    final=f"SELECT {O.as_double(*_MONEY_FACT)} FROM fo"))(_gold_as_written("fact_orders"))


@register("bronze_lineage", O.with_(*_LANDED, final="SELECT table_name, ingest_date, count(*) AS rows, 1::BIGINT AS stamps, "
          "0::BIGINT AS unstamped, 0::BIGINT AS misplaced FROM (" + " UNION ALL ".join(
              f"SELECT '{e}' AS table_name, ingest_date FROM land_{e}" for e in _ENTITIES) + ") GROUP BY table_name, ingest_date"))
def q_bronze_lineage(spark, sf):
    """Lineage of every bronze table: per day one load stamp, no row without
    one, and every source file in its day's folder."""
    lake = _end_to_end_lake(spark, sf)
    out = None
    for e in _ENTITIES:
        part = lineage_audit(read_table(spark, lake.path("bronze", e))).select(F.lit(e).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@register("bronze_drift_roundtrip", "SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in _CUSTOMER_LANDING)
          + ", CASE WHEN k <> 0 THEN 'web' END AS channel, CAST(ingest_date AS DATE) AS ingest_date "
          + f"FROM (SELECT *, date_diff('day', DATE '1970-01-01', CAST(ingest_date AS DATE)) % 3 AS k FROM ({feed_sql('customers')}) f)")
def q_bronze_drift_roundtrip(spark, sf):
    """Customers land with another header each day: as agreed, with a column
    inserted, with it appended and all columns in another order; bronze binds each by name."""
    root = scratch_path(spark, "drift")
    df = feed(spark, sf, "customers").select(*_CUSTOMER_LANDING, F.lit("web").alias("channel"), "ingest_date")
    k = F.unix_date(F.col("ingest_date").cast("date")) % 3
    key, *rest = _CUSTOMER_LANDING
    for n, names in enumerate((_CUSTOMER_LANDING, (key, "channel", *rest), (*reversed(_CUSTOMER_LANDING), "channel"))):
        write_landing(df.filter(k == n).select(*names, "ingest_date"), f"{root}/landing", "customers", mode="append")
    table = ingest_entity(spark, f"{root}/landing", f"{root}/bronze/customers", "customers", pattern=_DROPS, cluster=True)
    return table.select(*_CUSTOMER_LANDING, "channel", "ingest_date")


@register("bronze_export_roundtrip", _feed_sql("customers", ", ".join(f"nullif(trim({c}), '') AS {c}" for c in _CUSTOMER_LANDING) + ", ingest_date"))
def q_bronze_export_roundtrip(spark, sf):
    """Customers land, load into bronze with daily extracts, and are read
    back from the extracts (which trim the edges of text, as Spark's CSV writer does)."""
    root = scratch_path(spark, "bronze-export")
    write_landing(feed(spark, sf, "customers").select(*_CUSTOMER_LANDING, "ingest_date"), f"{root}/landing", "customers")
    run_bronze(spark, f"{root}/landing", Lake(f"{root}/lake", f"{root}/exports"), ["customers"], pattern=_DROPS, cluster=True)
    back = spark.read.option("header", True).option("delimiter", ";").csv(f"{root}/exports/bronze/customers")
    return back.select(*_CUSTOMER_LANDING, F.col("ingest_date").cast("date").alias("ingest_date"))


@register("bronze_replace_day", "SELECT customer_id, CASE WHEN k = 1 THEN 'corrected' ELSE nullif(state, '') END AS state, CAST(ingest_date AS DATE) AS ingest_date "
          f"FROM (SELECT *, date_diff('day', DATE '1970-01-01', CAST(ingest_date AS DATE)) % 3 AS k FROM ({feed_sql('customers')}) f) WHERE k <> 2")
def q_bronze_replace_day(spark, sf):
    """Days are loaded again: corrected (1 in 3), emptied (a header and no
    rows, 1 in 3) or for the first time (1 in 3)."""
    root = scratch_path(spark, "replace")
    df = feed(spark, sf, "customers").select("customer_id", "state", "ingest_date")
    k = F.unix_date(F.col("ingest_date").cast("date")) % 3
    write_landing(df.filter(k != 0), f"{root}/first", "customers")
    ingest_entity(spark, f"{root}/first", f"{root}/bronze", "customers", pattern=_DROPS, cluster=True)
    write_landing(df.filter(k == 0), f"{root}/second", "customers")
    write_landing(df.filter(k == 1).withColumn("state", F.lit("corrected")), f"{root}/second", "customers", mode="append")
    days = df.select("ingest_date", k.alias("k")).distinct().collect()
    for r in days:
        if r["k"] == 2:
            write_header(spark, f"{root}/second/customers/ingest_date={r['ingest_date']}/part-0.csv", "customer_id,state")
    table = ingest_entity(spark, f"{root}/second", f"{root}/bronze", "customers", pattern=_DROPS,
                          days=[str(r["ingest_date"]) for r in days], cluster=True)
    return table.select("customer_id", "state", "ingest_date")


def write_header(spark: SparkSession, path: str, line: str) -> None:
    """A landing file that holds its header line only."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(folder)
    out.write(bytearray(f"{line}\n", "utf-8"))
    out.close()


@register("silver_products_second_day", O.with_(
    *O.feeds("products"), *O.silver_products_ctes("feed_products"), *O.dim_products_ctes("sp"),
    final="SELECT sp.product_id, sp.category, sp.brand, sp.ingest_date, dp.category AS dim_category, dp.brand AS dim_brand "
          "FROM sp JOIN dp USING (product_id)"))
def q_silver_products_second_day(spark, sf):
    """Silver products (partitioned by load day) written after the earlier
    days, then again after all of them, and the dimension built from it: the
    second write leaves nothing of the first behind."""
    lake = Lake(scratch_path(spark, "second-day"))
    bronze = feed(spark, sf, "products")
    days = F.col("ingest_date").cast("date")
    middle = bronze.agg(F.percentile_approx(F.unix_date(days), 0.5).alias("d")).first()["d"]
    for part in (bronze.filter(F.unix_date(days) <= middle), bronze):
        write_table(part, lake.path("bronze", "products"))
        run_silver(spark, lake, ["products"])
        run_gold(spark, lake, ["dim_products"])
    dim = read_table(spark, lake.path("gold", "dim_products")).select("product_id", F.col("category").alias("dim_category"), F.col("brand").alias("dim_brand"))
    return read_table(spark, lake.path("silver", "products")).select("product_id", "category", "brand", "ingest_date").join(dim, "product_id")


_BAD_DAY = "CASE WHEN k = 0 THEN 'nope' WHEN k = 1 THEN NULL ELSE CAST(CAST(ingest_date AS DATE) AS VARCHAR) END"


@register("silver_orders_bad_load_day", O.with_(
    *O.feeds("orders"),
    ("bad", f"SELECT * REPLACE (TRY_CAST({_BAD_DAY} AS DATE) AS ingest_date) FROM "
            "(SELECT *, length(order_id) % 3 AS k FROM feed_orders)"),
    *O.silver_orders_ctes("bad"), final=f"SELECT {O.as_double('total_amount')} FROM so"))
def q_silver_orders_bad_load_day(spark, sf):
    """Load days as text, some of them no dates: they read as missing and never fail the job."""
    k = F.length("order_id") % 3
    day = F.when(k == 0, "nope").when(k == 1, F.lit(None)).otherwise(F.col("ingest_date").cast("date").cast("string"))
    return silver.silver_orders(feed(spark, sf, "orders").withColumn("ingest_date", day))


# --- incremental loads -----------------------------------------------------------------------------

def _loads(bronze: DataFrame, n: int) -> list[list[str]]:
    """The feed's days in ``n`` consecutive loads (days are few beside rows: one entry per day)."""
    days = sorted(str(r["d"]) for r in bronze.select(F.col("ingest_date").cast("date").alias("d")).distinct().collect())
    size = -(-len(days) // n)
    return [days[i:i + size] for i in range(0, len(days), size)]


def _bronze(spark, lake: Lake, entity: str, rows: DataFrame, mode: str = "overwrite") -> None:
    """Bronze rows, or more of them, in files of so few rows that a task, which reads files by bytes, has room to sort its own."""
    rows.write.mode(mode).option(*CODEC).option("maxRecordsPerFile", 250_000).parquet(lake.path("bronze", entity))


@register("silver_orders_incremental", ORACLE["silver_orders"])
def q_silver_orders_incremental(spark, sf):
    """Orders arrive in four loads.  The first is then found to be wrong (other rows, other
    values) and its days are replaced.  After every load only the keys it touched are worked out again."""
    lake, all_rows = Lake(scratch_path(spark, "silver-incremental")), feed(spark, sf, "orders")
    first, *rest = _loads(all_rows, 4)
    wrong = incremental.of_days(all_rows, first).withColumns({"order_id": F.when(F.length("order_id") % 2 == 0, F.concat("order_id", F.lit("x"))).otherwise(F.col("order_id")),
                                                              "status": F.lit("wrong"), "total_amount": F.lit("1.00")})
    _bronze(spark, lake, "orders", wrong)
    incremental.refresh(spark, lake, first, ["orders"])
    for days in (first, *rest):
        _bronze(spark, lake, "orders", incremental.of_days(all_rows, days), "overwrite" if days is first else "append")
        incremental.refresh(spark, lake, days, ["orders"])
    return read_table(spark, lake.path("silver", "orders"), merge_schema=False)


@register("fact_orders_incremental", ORACLE["fact_orders"])
def q_fact_orders_incremental(spark, sf):
    """Orders first, with the lines and shipments of the first half of the days; then the late lines and
    shipments.  Only orders that a late row reaches are joined and summed again."""
    lake = Lake(scratch_path(spark, "fact-incremental"))
    feeds = {e: feed(spark, sf, e) for e in ("orders", "order_items", "shipments")}
    early, late = _loads(feeds["order_items"], 2)
    orders_days = [d for load in _loads(feeds["orders"], 1) for d in load]
    for entity, rows in feeds.items():
        _bronze(spark, lake, entity, rows if entity == "orders" else incremental.of_days(rows, early))
    incremental.refresh(spark, lake, sorted({*orders_days, *early}), list(feeds))
    for entity in ("order_items", "shipments"):
        _bronze(spark, lake, entity, incremental.of_days(feeds[entity], late), "append")
    incremental.refresh(spark, lake, late, ["order_items", "shipments"])
    return read_table(spark, lake.path("gold", "fact_orders"), merge_schema=False)


@register("end_to_end_incremental", O.with_(
    *O.feeds("customers", "products"), *O.silver_customers_ctes("feed_customers"), *O.dim_customers_ctes("sc"), *O.silver_products_ctes("feed_products"), *O.dim_products_ctes("sp"),
    final="SELECT 'customer' AS kind, customer_id AS id, state AS first, city AS second, created_ts FROM dc "
          "UNION ALL SELECT 'product', product_id, category, brand, created_ts FROM dp"))
def q_end_to_end_incremental(spark, sf):
    """Both dimensions, day by day: each day is loaded on its own and only its keys move on to silver and gold."""
    lake = Lake(scratch_path(spark, "dims-incremental"))
    feeds = {e: feed(spark, sf, e) for e in ("customers", "products")}
    seen: list[str] = []
    for (day,) in _loads(feeds["customers"], 1_000_000):
        seen.append(day)
        for entity, rows in feeds.items():
            _bronze(spark, lake, entity, incremental.of_days(rows, seen))
        incremental.refresh(spark, lake, [day], list(feeds))
    customers, products = (read_table(spark, lake.path("gold", t), merge_schema=False) for t in ("dim_customers", "dim_products"))
    return customers.select(F.lit("customer").alias("kind"), F.col("customer_id").alias("id"), F.col("state").alias("first"), F.col("city").alias("second"), "created_ts").unionByName(
        products.select(F.lit("product").alias("kind"), F.col("product_id").alias("id"), F.col("category").alias("first"), F.col("brand").alias("second"), "created_ts"))


# --- tables laid out for their joins ---------------------------------------------------------------

def bucketed_fact_tables(spark: SparkSession, sf: str, buckets: int) -> dict[str, DataFrame]:
    """Silver orders and shipments and the item fact as tables bucketed and sorted by order."""
    stem = scratch_path(spark, "bucketed")
    name = "strata_" + stem.rsplit("-", 1)[1]
    frames = {"orders": orders_silver(spark, sf), "items": items_gold(spark, sf), "shipments": shipments_silver(spark, sf)}
    return {t: write_bucketed(df, f"{name}_{t}", f"{stem}/{t}", ["order_id"], buckets) for t, df in frames.items()}


@register("fact_orders_bucketed", ORACLE["fact_orders"])
def q_fact_orders_bucketed(spark, sf):
    """The order fact from bucketed tables: its sum and both joins read matching buckets, without an exchange."""
    t = bucketed_fact_tables(spark, sf, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return gold.fact_orders(t["orders"], t["items"], t["shipments"])


# --- error channel, drift, counts ------------------------------------------------------------------

_TYPED_ORDERS = {"order_ts": "TIMESTAMP", "total_amount": "DECIMAL(10, 2)"}


@register("contract_rejects", O.with_(
    *O.feeds("orders"),
    ("e", "SELECT " + ", ".join(f"trim({c}) <> '' AND TRY_CAST({c} AS {t}) IS NULL AS bad_{c}" for c, t in _TYPED_ORDERS.items()) + " FROM feed_orders"),
    ("b", "SELECT " + ", ".join(f"coalesce(bad_{c}, false) AS {c}" for c in _TYPED_ORDERS) + " FROM e"),
    final="SELECT 'accepted' AS outcome, NULL AS reason, count(*) AS rows FROM b WHERE NOT (order_ts OR total_amount) "
          "UNION ALL SELECT 'rejected', CASE WHEN order_ts AND total_amount THEN 'order_ts,total_amount' WHEN order_ts THEN 'order_ts' ELSE 'total_amount' END, count(*) "
          "FROM b WHERE order_ts OR total_amount GROUP BY 2"))
def q_contract_rejects(spark, sf):
    """Orders conformed with an error channel; rows accepted, and rows rejected by the columns that didn't parse."""
    accepted, rejected = write_conformed(feed(spark, sf, "orders"), CONTRACTS["orders"], scratch_path(spark, "conformed"))
    reasons = rejected.groupBy(F.array_join(F.array_sort(F.map_keys("errors")), ",").alias("reason")).agg(F.count(F.lit(1)).alias("rows"))
    return accepted.agg(F.count(F.lit(1)).alias("rows")).filter("rows > 0").select(F.lit("accepted").alias("outcome"), F.lit(None).cast("string").alias("reason"), "rows").unionByName(
        reasons.select(F.lit("rejected").alias("outcome"), "reason", "rows"))


@register("contract_rejected_rows", O.with_(
    *O.feeds("orders"),
    final="SELECT order_id, TRY_CAST(order_ts AS TIMESTAMP) AS order_ts, CAST(TRY_CAST(total_amount AS DECIMAL(10, 2)) AS DOUBLE) AS total_amount, "
          "CASE WHEN trim(order_ts) <> '' AND TRY_CAST(order_ts AS TIMESTAMP) IS NULL THEN order_ts END AS order_ts_text, "
          "CASE WHEN trim(total_amount) <> '' AND TRY_CAST(total_amount AS DECIMAL(10, 2)) IS NULL THEN total_amount END AS total_amount_text, source_file FROM feed_orders "
          "WHERE (trim(order_ts) <> '' AND TRY_CAST(order_ts AS TIMESTAMP) IS NULL) OR (trim(total_amount) <> '' AND TRY_CAST(total_amount AS DECIMAL(10, 2)) IS NULL)"))
def q_contract_rejected_rows(spark, sf):
    """The rejected rows themselves: what parsed, and the text of what did not."""
    _, rejected = write_conformed(feed(spark, sf, "orders"), CONTRACTS["orders"], scratch_path(spark, "conformed"))
    return rejected.select("order_id", "order_ts", "total_amount", *[F.element_at("errors", c).alias(f"{c}_text") for c in _TYPED_ORDERS], "source_file")


_DRIFT = {0: [("added", "channel"), ("missing", "city")], 1: [("moved", "customer_id"), ("moved", "state"), ("moved", "city"), ("moved", "created_ts")],
          2: [("renamed", "STATE"), ("added", "channel"), ("moved", "state"), ("moved", "city")]}


@register("landing_drift", "SELECT DISTINCT d.ingest_date, change, \"column\" FROM (SELECT CAST(ingest_date AS DATE) AS ingest_date, "
          f"date_diff('day', DATE '1970-01-01', CAST(ingest_date AS DATE)) % 3 AS k FROM ({feed_sql('customers')}) f) d JOIN (VALUES "
          + ", ".join(f"({k}, '{change}', '{column}')" for k, rows in _DRIFT.items() for change, column in rows) + ") v(k, change, \"column\") USING (k)")
def q_landing_drift(spark, sf):
    """Customers land under another header each day; how each day's headers differ from the contract."""
    root = scratch_path(spark, "header-drift")
    df = feed(spark, sf, "customers").select(*_CUSTOMER_LANDING, F.lit("web").alias("channel"), "ingest_date")
    k = F.unix_date(F.col("ingest_date").cast("date")) % 3
    layouts = (["customer_id", "channel", "state", "created_ts"], [*reversed(_CUSTOMER_LANDING)],
               ["customer_id", "city", F.col("state").alias("STATE"), "channel", "created_ts"])
    for n, layout in enumerate(layouts):
        write_landing(df.filter(k == n).select(*layout, "ingest_date"), f"{root}/landing", "customers", mode="append")
    return header_drift(spark, f"{root}/landing", "customers", _CUSTOMER_LANDING, pattern=_DROPS)


@register("quality_summary_written", _summary_sql())
def q_quality_summary_written(spark, sf):
    """The quality summary taken while the silver tables are written, all five at once."""
    lake = Lake(scratch_path(spark, "observed"))
    counts = run_silver_observed(spark, lake, {e: feed(spark, sf, e) for e in _ENTITIES})
    return audit.written_summary(spark, counts)


@register("bronze_rows_from_footers", O.with_(*_LANDED, final=" UNION ALL ".join(
    f"SELECT '{e}' AS table_name, ingest_date, count(*) AS rows FROM land_{e} GROUP BY 2" for e in _ENTITIES)))
def q_bronze_rows_from_footers(spark, sf):
    """Rows per day of every bronze table of the end-to-end run, from Parquet footers."""
    lake = _end_to_end_lake(spark, sf)
    parts = [footer_counts(spark, lake.path("bronze", e), "ingest_date").select(F.lit(e).alias("table_name"), "ingest_date", "rows") for e in _ENTITIES]
    return reduce(DataFrame.unionByName, parts)


@register("dim_export_single_file", O.with_(
    *O.feeds("products"), *O.silver_products_ctes("feed_products"), *O.dim_products_ctes("sp"), final="SELECT product_id, category, brand, 1::BIGINT AS files FROM dp"))
def q_dim_export_single_file(spark, sf):
    """The product dimension as one extract file, read back, with the number of files it was read from."""
    path = scratch_path(spark, "single-file")
    table = gold.dim_products(silver.silver_products(feed(spark, sf, "products")))
    export_csv(table, path, single_file=True)
    back = spark.read.option("header", True).option("delimiter", ";").schema(all_text(table.columns)).csv(path).withColumn("file", F.col("_metadata.file_path"))
    files = back.agg(F.countDistinct("file").alias("files"))
    return back.select("product_id", "category", "brand").join(F.broadcast(files))


@register("silver_orders_lineage", O.with_(
    *O.feeds("orders"), *O.silver_orders_ctes("feed_orders"),
    ("h", "SELECT order_id, count(*) - 1 AS superseded FROM feed_orders WHERE order_id IS NOT NULL GROUP BY order_id"),
    ("t", f"SELECT *, {O.parse_ts('order_ts')} AS ts, {O.parse_decimal('total_amount')} AS amount FROM feed_orders WHERE order_id IS NOT NULL"),
    ("w", "SELECT order_id, source_file FROM t QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY CAST(ingest_date AS DATE) DESC NULLS LAST, ingestion_ts DESC NULLS LAST, "
          "customer_id NULLS FIRST, status NULLS FIRST, payment_method NULLS FIRST, currency NULLS FIRST, ts NULLS FIRST, amount NULLS FIRST) = 1"),
    final="SELECT so.order_id, so.status, so.ingest_date, superseded, source_file FROM so JOIN h USING (order_id) JOIN w USING (order_id)"))
def q_silver_orders_lineage(spark, sf):
    """Each silver order with the file it came from and the number of loaded rows it superseded."""
    return silver.silver_orders(feed(spark, sf, "orders"), lineage=True).select("order_id", "status", "ingest_date", "superseded", "source_file")
