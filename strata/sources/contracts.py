"""Declared table contracts and ``conform``.

A contract is the schema a bronze table is meant to have once typed.  The
pipeline itself types columns step by step in the silver stage; ``conform``
is the generic form: select the contract's columns in its order, ``try_cast``
each one to the declared type (bad text -> null, never an error) and add any
missing column as a typed null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType, IntegerType, MapType, StringType, StructField, StructType, TimestampType


def _contract(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# --- fixed values: fields of the bronze tables ------------------------------------------
_LINEAGE = (("ingestion_ts", TimestampType()), ("ingest_date", StringType()), ("source_file", StringType()))
_TEXT, _TS, _MONEY = StringType(), TimestampType(), DecimalType(10, 2)

ORDERS = _contract(("order_id", _TEXT), ("customer_id", _TEXT), ("order_ts", _TS), ("status", _TEXT),
                   ("payment_method", _TEXT), ("total_amount", _MONEY), ("currency", _TEXT), *_LINEAGE)
# quantity is declared int, but the feeds carry decimals ("2.5"); the silver
# stage parses it as money first and floors it (see ``silver_order_items``).
ORDER_ITEMS = _contract(("order_id", _TEXT), ("product_id", _TEXT), ("quantity", IntegerType()),
                        ("unit_price", _MONEY), ("discount_amount", _MONEY), *_LINEAGE)
SHIPMENTS = _contract(("order_id", _TEXT), ("carrier", _TEXT), ("shipping_cost", _MONEY), ("shipped_ts", _TS),
                      ("delivered_ts", _TS), ("delivery_status", _TEXT), *_LINEAGE)
CUSTOMERS = _contract(("customer_id", _TEXT), ("state", _TEXT), ("city", _TEXT), ("created_ts", _TS), *_LINEAGE)
PRODUCTS = _contract(("product_id", _TEXT), ("category", _TEXT), ("brand", _TEXT), ("created_ts", _TS), *_LINEAGE)
# -----------------------------------------------------------------------------

CONTRACTS: dict[str, StructType] = {
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "shipments": SHIPMENTS,
    "customers": CUSTOMERS,
    "products": PRODUCTS,
}

LINEAGE_COLUMNS = tuple(name for name, _ in _LINEAGE)


def business_columns(entity: str) -> list[str]:
    """The contract's columns without the lineage ones, in order."""
    return [f.name for f in CONTRACTS[entity].fields if f.name not in LINEAGE_COLUMNS]


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """Select, order and ``try_cast`` ``df`` to ``contract``; missing -> typed null."""
    present = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for field in contract.fields:
        if field.name not in present:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif present[field.name] == field.dataType:
            cols.append(F.col(field.name))
        else:
            cols.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
    return df.select(*cols)


def parse_errors(df: DataFrame, contract: StructType) -> Column:
    """Per row: the contract's columns whose text is there but doesn't parse, with that text
    (a map; empty if all parse).  Blank text is a missing value, not an error."""
    present = {f.name: f.dataType for f in df.schema.fields}
    wrong = []
    for field in contract.fields:
        if isinstance(present.get(field.name), StringType) and not isinstance(field.dataType, StringType):
            c = F.col(field.name)
            bad = (F.trim(c) != "") & c.try_cast(field.dataType).isNull()
            wrong.append(F.when(bad, F.struct(F.lit(field.name).alias("key"), c.alias("value"))))
    if not wrong:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.map_from_entries(F.filter(F.array(*wrong), lambda e: e.isNotNull()))


def write_conformed(df: DataFrame, contract: StructType, path: str) -> tuple[DataFrame, DataFrame]:
    """``conform`` with an error channel: one pass writes every row to exactly one of two tables.

    Rows that parse in full go to ``<path>/rejected=false``, the others to
    ``<path>/rejected=true`` with ``errors`` (column -> text that didn't parse);
    the columns that did parse are kept.  Returns (accepted, rejected), read back."""
    spark, errors = df.sparkSession, "__errors"
    parsed = conform(df.withColumn(errors, parse_errors(df, contract)), StructType([*contract.fields, StructField(errors, MapType(StringType(), StringType()), True)]))
    parsed = parsed.withColumn("rejected", F.size(errors) > 0).withColumnRenamed(errors, "errors")
    parsed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("rejected").parquet(path)
    schema = StructType([*contract.fields, StructField("errors", MapType(StringType(), StringType()), True), StructField("rejected", BooleanType(), True)])
    both = spark.read.schema(schema).parquet(path)
    return both.filter("not rejected").drop("errors", "rejected"), both.filter("rejected").drop("rejected")


def all_text(columns) -> StructType:
    """An all-string schema (how landing files are read: nothing inferred)."""
    return StructType([StructField(c, StringType(), True) for c in columns])
