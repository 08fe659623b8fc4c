"""Incremental silver and gold: a load's days change some keys; only those are worked out again.

A silver row is the newest row of its key, so it stands for the key's bronze rows of all days that a
load leaves alone, unless it came from a day that the load replaced (the day may hold it no longer).
``silver_again`` works out the load's own rows, with the other days' history of those ``withdrawn_keys``
only, and ``put_newer`` settles the result against the rows that stay, by load day.
``changed_keys`` finds the keys that a load can change, for what follows from silver: an order is worked out
again by ``merge_fact_orders`` if its own row, any of its lines or its shipment changed; the item
fact is silver's rows one by one, so it follows them without a join.  Every merge of a dimension is an anti join and a semi
join on keys, so its shuffle grows with what changed; the result equals a full run.

The tables that grow with the orders are ``BUCKETED`` by their keys.  A load's rows are dealt by key once, for their newest
row; what they are then settled against (``settle``), summed up to or joined with lies in the same buckets, so no stored row is
sent again except the reached orders' lines, which the order fact sums by order.

``run_days`` does it on a lake: bronze days, then silver, then gold, each table
written whole beside the old one and then put in its place.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import gold
from strata.plans.pipeline import SILVER_PARTITIONS, SILVER_STAGES, Lake, run_bronze
from strata.session import scratch_path
from strata.sinks.writers import replace_bucketed, replace_table, write_table
from strata.sources.landing import DEFAULT_PATTERN
from strata.sources.tables import read_bucketed, read_if_exists, read_table

# keys of the silver tables
KEYS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "products": ("product_id",),
    "orders": ("order_id",),
    "order_items": ("order_id", "product_id"),
    "shipments": ("order_id",),
}
# tables kept in buckets, and by which columns
BUCKETED: dict[tuple[str, str], tuple[str, ...]] = {
    ("silver", "orders"): KEYS["orders"],
    ("silver", "order_items"): KEYS["order_items"],
    ("silver", "shipments"): KEYS["shipments"],
    ("gold", "fact_orders"): ("order_id",),
}


def of_days(df: DataFrame, days: Sequence[str], day_col: str = "ingest_date") -> DataFrame:
    """Rows of these days (ISO dates): one ``IN`` of literals, which prunes a table partitioned by day."""
    return df.filter(_in_days(days, day_col)) if days else df.limit(0)


def other_days(df: DataFrame, days: Sequence[str], day_col: str = "ingest_date") -> DataFrame:
    """Rows of all other days, and of none."""
    return df.filter(f"NOT coalesce({_in_days(days, day_col)}, false)") if days else df


def _in_days(days: Sequence[str], day_col: str) -> str:
    literals = ", ".join(f"DATE'{date.fromisoformat(d)}'" for d in days)
    return f"try_cast({day_col} AS date) IN ({literals})"


def changed_keys(bronze: DataFrame, current: DataFrame | None, keys: Sequence[str], days: Sequence[str]) -> DataFrame:
    """Distinct keys of the bronze rows of ``days`` and of the silver rows that came from them."""
    loaded = of_days(bronze, days).select(*[F.col(k).cast("string").alias(k) for k in keys]).dropna()
    if current is not None:
        loaded = loaded.unionByName(of_days(current, days).select(*keys))
    return loaded.distinct()


def put_in(current: DataFrame | None, changed: DataFrame, again: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``current`` with the rows of ``changed`` keys replaced by ``again`` (which may have none for a key)."""
    if current is None:
        return again
    return current.join(changed, list(keys), "left_anti").select(*again.columns).unionByName(again)


def withdrawn_keys(current: DataFrame, keys: Sequence[str], days: Sequence[str]) -> DataFrame:
    """Keys whose silver row came from one of ``days``: their other rows have to be looked at again."""
    return of_days(current, days).select(*keys)


def silver_again(entity: str, bronze: DataFrame, days: Sequence[str], unsettled: DataFrame | None, **options) -> DataFrame:
    """Silver rows of the load's own rows, and of the ``unsettled`` keys' rows of all other days."""
    rows = of_days(bronze, days)
    if unsettled is not None:
        rows = rows.unionByName(other_days(bronze, days).join(unsettled, list(KEYS[entity]), "left_semi"))
    return SILVER_STAGES[entity](rows, **options)


def put_newer(settled: DataFrame, again: DataFrame, keys: Sequence[str], days: Sequence[str], day_col: str = "ingest_date") -> DataFrame:
    """``settled`` silver rows (none from ``days``) with those of ``again`` put in; of a key that both have, the later day's.

    The two never share a day, and a missing day is the earliest.  Only settled rows later than
    the load's first day can stay, so a load of the newest days looks for none."""
    late = settled.filter(F.col(day_col) > F.lit(date.fromisoformat(min(days)))) if days else settled.limit(0)
    if not late.isEmpty():
        loaded = again.select(*keys, F.col(day_col).alias("__loaded"))
        stay = late.select(*keys, day_col).join(loaded, list(keys)).filter(F.col(day_col) > F.col("__loaded")).select(*keys)
        again = again.join(stay, list(keys), "left_anti")
    return put_in(settled, again.select(*keys), again, keys)


def settle(settled: DataFrame, again: DataFrame, keys: Sequence[str], day_col: str = "ingest_date") -> DataFrame:
    """``put_newer`` side by side, in one pass of a full outer join: for tables in buckets, where neither side is sent for it."""
    rest = [c for c in again.columns if c not in keys]
    old, new = (df.select(*keys, F.struct(*rest).alias(name)) for df, name in ((settled, "__old"), (again, "__new")))
    stays = F.col("__new").isNull() | F.coalesce(F.col(f"__old.{day_col}") > F.col(f"__new.{day_col}"), F.lit(False))
    row = F.when(stays, F.col("__old")).otherwise(F.col("__new")).alias("__row")
    return old.join(new, list(keys), "full_outer").select(*keys, row).select(*[c if c in keys else F.col(f"__row.{c}") for c in again.columns])


def merge_gold_items(items: DataFrame) -> DataFrame:
    """The item fact after a load: silver ``items`` row by row, so no key has to be looked up in the old one."""
    return gold.fact_order_items(items)


def changed_orders(loads: dict[str, tuple[DataFrame | None, DataFrame | None]], days: Sequence[str]) -> DataFrame:
    """Distinct order ids that a load of orders, their lines or their shipments reaches; ``loads``: by entity, tables
    whose rows of ``days`` name them (silver before and after the load, say)."""
    ids = []
    for entity in ("orders", "order_items", "shipments"):
        if entity in loads:
            ids += [of_days(df, days).dropna(subset=list(KEYS[entity])).select(F.col("order_id").cast("string").alias("order_id")) for df in loads[entity] if df is not None]
    return reduce(DataFrame.unionByName, ids).distinct()


def merge_fact_orders(orders: DataFrame, items: DataFrame, shipments: DataFrame | None, current: DataFrame | None, reached: DataFrame | None, **options) -> DataFrame:
    """The order fact after a load: only the ``reached`` orders (None: all of them) are joined and summed again."""
    def of(df: DataFrame | None) -> DataFrame | None:
        return df if df is None or reached is None else df.join(reached, "order_id", "left_semi")

    again = gold.fact_orders(of(orders), of(items), of(shipments), **options)
    return again if reached is None else put_in(current, reached, again, ["order_id"])


def run_days(spark: SparkSession, landing: str, lake: Lake, days: Sequence[str], entities: Sequence[str] = tuple(KEYS), pattern: str = DEFAULT_PATTERN,
             cluster: bool = False, silver_options: dict[str, dict] | None = None, fact_options: dict | None = None) -> Lake:
    """Load ``days`` into bronze and bring silver and gold up to date with them."""
    run_bronze(spark, landing, lake, entities, days=days, pattern=pattern, cluster=cluster)
    return refresh(spark, lake, days, entities, silver_options, fact_options)


def refresh(spark: SparkSession, lake: Lake, days: Sequence[str], entities: Sequence[str] = tuple(KEYS), silver_options: dict[str, dict] | None = None,
            fact_options: dict | None = None) -> Lake:
    """Silver and gold of a lake whose bronze ``days`` were loaded or replaced."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))  # as many as the tasks that a load's rows are dealt to

    def kept(df: DataFrame, name: str, keys: Sequence[str] = ()) -> DataFrame:
        # written first: the tables it was worked out from are about to be replaced
        path = scratch_path(spark, name)
        if keys:
            replace_bucketed(df, path, keys, buckets)
            return read_bucketed(spark, path, keys)
        write_table(df, path)
        return spark.read.schema(df.schema).parquet(path)

    def table(layer: str, name: str) -> DataFrame | None:
        if (layer, name) in BUCKETED:
            return read_bucketed(spark, lake.path(layer, name), BUCKETED[layer, name])
        return read_if_exists(spark, lake.path(layer, name), merge_schema=False)

    def replace(df: DataFrame, layer: str, name: str) -> None:
        path = lake.path(layer, name)
        if (layer, name) in BUCKETED:
            replace_bucketed(df, path, BUCKETED[layer, name], buckets)
        else:
            replace_table(df, path, SILVER_PARTITIONS.get(name, ()) if layer == "silver" else ())
        lake.written[f"{layer}/{name}"] = path

    loads = {e: (read_table(spark, lake.path("bronze", e)), table("silver", e)) for e in entities}
    of_orders = [e for e in ("orders", "order_items", "shipments") if e in loads]
    facts = (bool(of_orders) and ("orders" in loads or table("silver", "orders") is not None)
             and ("order_items" in loads or table("gold", "fact_order_items") is not None))
    changed = {e: kept(changed_keys(*loads[e], KEYS[e], days), f"changed-{e}") for e in ("customers", "products") if e in loads}
    withdrawn: dict[str, DataFrame] = {}
    for entity, (bronze, current) in loads.items():
        keys, options = KEYS[entity], (silver_options or {}).get(entity, {})
        # without a silver table, no row of another day is settled; nor is one to be looked at if there is none
        unsettled = changed_keys(bronze, None, keys, days) if current is None else withdrawn_keys(current, keys, days)
        if unsettled.isEmpty():
            unsettled = None
        elif facts and current is not None and entity in of_orders:
            withdrawn[entity] = kept(of_days(current, days).select(*keys, "ingest_date"), f"withdrawn-{entity}")
        if unsettled is not None and other_days(bronze, days).isEmpty():
            unsettled = None
        again = silver_again(entity, bronze, days, unsettled, **options)
        if current is not None and ("silver", entity) in BUCKETED:
            again = settle(other_days(current, days), again, keys)
        elif current is not None:
            again = put_newer(other_days(current, days), kept(again, f"again-{entity}"), keys, days)
        replace(again, "silver", entity)

    # the dimensions have one row per silver row, so they follow silver's keys alike
    for entity, name, build in (("customers", "dim_customers", gold.dim_customers), ("products", "dim_products", gold.dim_products)):
        if entity in changed:
            again = build(table("silver", entity).join(changed[entity], list(KEYS[entity]), "left_semi"))
            replace(put_in(table("gold", name), changed[entity], again, KEYS[entity]), "gold", name)
    if "order_items" in loads:
        replace(merge_gold_items(table("silver", "order_items")), "gold", "fact_order_items")
    if facts:
        current = table("gold", "fact_orders")
        # an order changes with the silver rows that the load put in or took away; without a fact, every order is to be worked out
        reached = None if current is None else kept(changed_orders({e: (withdrawn.get(e), table("silver", e)) for e in of_orders}, days), "changed-orders", ["order_id"])
        replace(merge_fact_orders(table("silver", "orders"), table("gold", "fact_order_items"), table("silver", "shipments"), current, reached, **(fact_options or {})), "gold", "fact_orders")
    return lake
