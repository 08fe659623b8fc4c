"""Keep the newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

ColumnOrName = Column | str

_RN = "__strata_rn"


def _sort_key(c: ColumnOrName) -> Column:
    return F.col(c).asc_nulls_first() if isinstance(c, str) else c


def _orderable(dtype: DataType) -> bool:
    """Whether Spark can sort on the type (maps and variants cannot be ordered)."""
    if isinstance(dtype, (MapType, VariantType)):
        return False
    if isinstance(dtype, ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def recency(*cols: str) -> list[Column]:
    """Newest first on each column, nulls last (``ingest_date``, ``ingestion_ts``, ...)."""
    return [F.col(c).desc_nulls_last() for c in cols]


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnOrName],
    tie_break: Sequence[ColumnOrName] | None = None,
) -> DataFrame:
    """One row per ``keys``: the first row under ``order`` then ``tie_break``.

    ``order`` holds sort expressions (see ``recency``); ``tie_break`` makes
    the choice deterministic when the recency columns tie (rows of one load
    share their ingestion stamp).  It defaults to every other column Spark
    can order (maps cannot be sorted), ascending with nulls first; a plain
    column name means exactly that.

    Written as ``row_number() == 1`` over a key window, which Spark plans as a
    ``WindowGroupLimit``: a partial top-1 per key runs before the shuffle, so
    a key that holds a large share of the rows sends one row per map task,
    not all of them, to its reducer.
    """
    keys = list(keys)
    if tie_break is None:
        tie_break = [f.name for f in df.schema.fields if f.name not in keys and _orderable(f.dataType)]
    ordering = [_sort_key(c) for c in list(order) + list(tie_break)]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_with_count(df: DataFrame, keys: Sequence[str], newest: Sequence[str], tie_break: Sequence[str], superseded: str) -> DataFrame:
    """``latest_by`` over the date or timestamp columns ``newest`` (latest first, nulls last)
    and the columns ``tie_break`` (ascending, nulls first), with the number of other rows of the key.

    Every row counts here, so a window's top-1 before the shuffle can't serve.  The
    row to keep is the least struct of sort values instead, next to a count: both are
    partial aggregates, so a hot key still sends one row per map task through the one exchange."""
    recent = [F.struct(F.col(c).isNull().alias("none"), (-F.unix_micros(F.col(c).cast("timestamp"))).alias("back")) for c in newest]
    ties = [F.struct(F.col(c).isNotNull().alias("some"), F.col(c).alias("value")) for c in tie_break]
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[r.alias(f"r{i}") for i, r in enumerate(recent + ties)], F.struct(*rest).alias("row"))
    found = df.groupBy(*keys).agg(F.min(ranked).alias("first"), (F.count(F.lit(1)) - 1).alias(superseded))
    return found.select(*keys, *[F.col(f"first.row.{c}").alias(c) for c in rest], superseded)
