"""The end-to-end pipeline: landing CSV -> bronze -> silver -> gold.

Each layer is written as Parquet and the next layer reads it back.  That
cuts the lineage at every layer (a lost executor recomputes from the last
written table, not from the raw files), runs each plan once (extracts are
taken from the written table, not by re-running the plan) and lets every
stage be re-run on its own.

Paths: ``<lake>/bronze/<entity>``, ``<lake>/silver/<entity>``,
``<lake>/gold/<table>``; optional CSV extracts under ``<exports>/<layer>/<name>``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import gold, silver
from strata.operators.audit import SILVER_FLAGS
from strata.sinks.writers import export_csv, export_days, write_observed, write_table
from strata.sources.contracts import LINEAGE_COLUMNS, business_columns
from strata.sources.landing import DEFAULT_PATTERN, ingest_entity
from strata.sources.tables import read_if_exists, read_table

ENTITIES = ("customers", "products", "orders", "order_items", "shipments")
GOLD_TABLES = ("dim_customers", "dim_products", "fact_order_items", "fact_orders")

SILVER_STAGES = {
    "customers": silver.silver_customers,
    "products": silver.silver_products,
    "orders": silver.silver_orders,
    "order_items": silver.silver_order_items,
    "shipments": silver.silver_shipments,
}
# silver products is partitioned by load day, like bronze
SILVER_PARTITIONS = {"products": ("ingest_date",)}
SINGLE_FILE_TABLES = ("dim_customers", "dim_products")


def fan_out(tasks: dict[str, Callable[[], object]], parallel: bool) -> dict[str, object]:
    """Run independent stages, concurrently when ``parallel``.

    Each stage is its own Spark job; jobs submitted from several threads of
    one application run side by side and share the executors, so small
    stages overlap instead of queueing one behind another."""
    if not parallel or len(tasks) < 2:
        return {name: task() for name, task in tasks.items()}
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = {name: pool.submit(task) for name, task in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


@dataclass
class Lake:
    """Where the layers live: ``<root>/<layer>/<name>``; CSV extracts, when
    wanted, under ``<exports>/<layer>/<name>``.  ``single_file_exports`` makes
    the extracts of the two dimensions one file each; the other tables
    grow with the orders and always keep one file per task."""
    root: str
    exports: str | None = None
    single_file_exports: bool = False
    written: dict[str, str] = field(default_factory=dict)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"


def _publish(spark: SparkSession, lake: Lake, df: DataFrame, layer: str, name: str,
             partition_by: Sequence[str] = ()) -> DataFrame:
    path = lake.path(layer, name)
    write_table(df, path, partition_by)
    lake.written[f"{layer}/{name}"] = path
    table = read_table(spark, path, merge_schema=False)  # written whole by one job: one schema
    if lake.exports:
        single = lake.single_file_exports and name in SINGLE_FILE_TABLES
        export_csv(table, f"{lake.exports.rstrip('/')}/{layer}/{name}", single_file=single)
    return table


def run_bronze(spark: SparkSession, landing: str, lake: Lake, entities: Sequence[str] = ENTITIES,
               days: Sequence[str] | None = None, by_header: bool = True, pattern: str = DEFAULT_PATTERN,
               parallel: bool = True, cluster: bool = False) -> None:
    """Load every entity (or only ``days``) into bronze, idempotently per day.

    ``by_header`` binds CSV columns by header name (safe under any schema
    drift); ``False`` binds the contract's columns by position and fails on
    files with any other header.  With ``exports`` the loaded days are also
    written as extracts, from the written table.  ``cluster`` gathers each
    day before the write (for backfills of many days).
    ``pattern`` locates an entity's files under ``landing`` (see
    ``strata.sources.landing``).  Entities load concurrently when
    ``parallel``."""
    def load(entity: str) -> Callable[[], None]:
        def task() -> None:
            path = lake.path("bronze", entity)
            table = ingest_entity(spark, landing, path, entity, columns=None if by_header else business_columns(entity),
                                  pattern=pattern, days=days, by_header=by_header, cluster=cluster)
            if lake.exports:
                loaded = table.filter(F.col("ingest_date").isin([F.lit(d).cast("date") for d in days])) if days else table
                loaded = loaded.select(*[c for c in loaded.columns if c not in LINEAGE_COLUMNS], *LINEAGE_COLUMNS)
                export_days(loaded, f"{lake.exports.rstrip('/')}/bronze/{entity}")
            lake.written[f"bronze/{entity}"] = path
        return task

    fan_out({entity: load(entity) for entity in entities}, parallel)


def run_silver(spark: SparkSession, lake: Lake, entities: Sequence[str] = ENTITIES, parallel: bool = True,
               **options) -> dict[str, DataFrame]:
    """Every silver entity from its bronze table (concurrently when
    ``parallel``); ``options`` by entity, e.g. ``orders={"strict": True}``."""
    def build(entity: str) -> Callable[[], DataFrame]:
        def task() -> DataFrame:
            bronze = read_table(spark, lake.path("bronze", entity))
            stage = SILVER_STAGES[entity]
            return _publish(spark, lake, stage(bronze, **options.get(entity, {})), "silver", entity,
                            SILVER_PARTITIONS.get(entity, ()))
        return task

    return fan_out({entity: build(entity) for entity in entities}, parallel)


def run_silver_observed(spark: SparkSession, lake: Lake, bronze: dict[str, DataFrame], parallel: bool = True, **options) -> dict[str, dict[str, int]]:
    """Every silver entity written from its bronze frame, and its quality counts (rows, and
    rows with each flag true), taken by the write itself: {entity: {measure: count}}."""
    def build(entity: str) -> Callable[[], dict[str, int]]:
        def task() -> dict[str, int]:
            path = lake.path("silver", entity)
            counts = write_observed(SILVER_STAGES[entity](bronze[entity], **options.get(entity, {})), path, SILVER_FLAGS[entity], SILVER_PARTITIONS.get(entity, ()))
            lake.written[f"silver/{entity}"] = path
            return counts
        return task

    return fan_out({entity: build(entity) for entity in bronze}, parallel)


def run_gold(spark: SparkSession, lake: Lake, tables: Sequence[str] = GOLD_TABLES,
             parallel: bool = True, **fact_options) -> dict[str, DataFrame]:
    """Dimensions and the item fact from silver (concurrently when
    ``parallel``); then the order fact from silver orders, the *gold* item
    fact, and silver shipments / payments when present.  ``fact_options`` go
    to ``gold.fact_orders`` (``payment_source``, ``payment_default``, ``valid_only``)."""
    # silver tables are written whole by one job, so their files share one
    # schema and reading them needs no footer merge (bronze does: it
    # accumulates days whose headers drift)
    def silver_table(name: str) -> DataFrame:
        return read_table(spark, lake.path("silver", name), merge_schema=False)

    first: dict[str, Callable[[], DataFrame]] = {}
    if "dim_customers" in tables:
        first["dim_customers"] = lambda: _publish(
            spark, lake, gold.dim_customers(silver_table("customers")), "gold", "dim_customers")
    if "dim_products" in tables:
        first["dim_products"] = lambda: _publish(
            spark, lake, gold.dim_products(silver_table("products")), "gold", "dim_products")
    if "fact_order_items" in tables or "fact_orders" in tables:
        first["fact_order_items"] = lambda: _publish(
            spark, lake, gold.fact_order_items(silver_table("order_items")),
            "gold", "fact_order_items")
    out = fan_out(first, parallel)
    if "fact_orders" in tables:
        orders = silver_table("orders")
        shipments = read_if_exists(spark, lake.path("silver", "shipments"), merge_schema=False)
        payments = read_if_exists(spark, lake.path("silver", "payments"), merge_schema=False)
        out["fact_orders"] = _publish(
            spark, lake, gold.fact_orders(orders, out["fact_order_items"], shipments, payments, **fact_options),
            "gold", "fact_orders")
    return out


def run_pipeline(spark: SparkSession, landing: str, lake_root: str, exports: str | None = None,
                 days: Sequence[str] | None = None, entities: Sequence[str] = ENTITIES,
                 gold_tables: Sequence[str] = GOLD_TABLES, by_header: bool = True,
                 pattern: str = DEFAULT_PATTERN, parallel: bool = True, single_file_exports: bool = False,
                 cluster: bool = False, silver_options: dict[str, dict] | None = None,
                 fact_options: dict | None = None) -> Lake:
    """bronze -> silver -> gold, in dependency order; inside a layer the
    independent stages run concurrently when ``parallel``.  See ``run_silver``
    and ``run_gold`` for the options."""
    lake = Lake(lake_root, exports, single_file_exports)
    run_bronze(spark, landing, lake, entities=entities, days=days, by_header=by_header, pattern=pattern,
               parallel=parallel, cluster=cluster)
    run_silver(spark, lake, entities=entities, parallel=parallel, **(silver_options or {}))
    run_gold(spark, lake, gold_tables, parallel=parallel, **(fact_options or {}))
    return lake
