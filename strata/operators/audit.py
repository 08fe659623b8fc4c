"""Quality summaries and referential audits.

All are global or low-cardinality aggregates: each map task pre-aggregates
its rows, so only a handful of partial rows cross the shuffle however large
or skewed the input is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: quality flags of the silver tables -----------------------------------
SILVER_FLAGS: dict[str, tuple[str, ...]] = {
    "customers": ("has_null_required_fields",),
    "products": ("has_null_required_fields", "is_valid_record"),
    "orders": ("is_currency_defaulted", "is_total_amount_defaulted", "has_foreign_currency",
               "has_null_required_fields", "has_invalid_values", "is_valid_record"),
    "order_items": ("has_invalid_quantity", "is_valid_item"),
    "shipments": ("is_shipping_cost_defaulted", "has_null_required_fields", "has_invalid_values",
                  "is_valid_record"),
}
# -----------------------------------------------------------------------------


def flag_counts(df: DataFrame, table: str, flags: Sequence[str]) -> DataFrame:
    """One row per measure: ``(table_name, measure, value)`` with the row count
    and, per flag, how many rows have it true (null counts as not true)."""
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f)).alias(f) for f in flags],
    )
    measures = ["rows", *flags]
    return wide.select(
        F.lit(table).alias("table_name"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("long").alias("value"))
                            for m in measures])).alias("m"),
    ).select("table_name", "m.measure", "m.value")


def quality_summary(tables: dict[str, DataFrame], flags: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Flag counts of several tables, stacked (``flag_counts`` per table)."""
    flags = flags or SILVER_FLAGS
    parts = [flag_counts(df, name, flags[name]) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def written_summary(spark: SparkSession, counts: dict[str, dict[str, int]]) -> DataFrame:
    """``quality_summary`` from counts taken while the tables were written
    (``writers.write_observed``): one row per table and measure, nothing is scanned."""
    rows = [(table, measure, n) for table, seen in counts.items() for measure, n in seen.items()]
    return spark.createDataFrame(rows, "table_name string, measure string, value long")


def flag_profile(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows per combination of flag values (three-valued flags keep their nulls)."""
    return df.groupBy(*flags).agg(F.count(F.lit(1)).alias("rows"))


def orphan_audit(parents: DataFrame, children: DataFrame, key: str = "order_id") -> DataFrame:
    """One row: child rows whose key has no parent (``orphan_rows``), their
    distinct keys (``orphan_keys``) and parent keys without any child
    (``parents_without_children``).

    Children are first counted per key (partial aggregation, so a hot key
    costs one row per map task), parents reduced to distinct keys; one full
    outer join on the key then labels each side, and a global aggregate
    counts.  Both sides arrive hash-partitioned by the key, so the join adds
    no shuffle of its own."""
    parent_keys = (parents.select(key).filter(F.col(key).isNotNull())
                   .distinct().withColumn("__has_parent", F.lit(True)))
    child_counts = (children.select(key).filter(F.col(key).isNotNull())
                    .groupBy(key).agg(F.count(F.lit(1)).alias("__children")))
    both = parent_keys.join(child_counts, key, "full_outer")
    orphan = F.col("__has_parent").isNull()
    return both.agg(
        F.coalesce(F.sum(F.when(orphan, F.col("__children"))), F.lit(0)).cast("long").alias("orphan_rows"),
        F.count_if(orphan).alias("orphan_keys"),
        F.count_if(F.col("__children").isNull()).alias("parents_without_children"),
    )
