"""Column builders for cleaning raw text columns.

Each function takes and returns a ``Column`` and uses only built-in Spark
expressions, so everything stays inside whole-stage codegen.  With ANSI mode
on (the Spark 4 default) a plain cast of bad text raises; every parse here
uses a ``try_`` form so unparsable values become null instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from strata.fixed import ACCENTED, DMY_MINUTES, MONEY_PRECISION, MONEY_SCALE, NO_VALUE, UNACCENTED

ColumnOrName = Column | str

# Timestamp text accepted by default is whatever a cast to timestamp accepts
# (ISO 8601 date, date-time with a space or a "T"); ``DMY_MINUTES`` is opt-in.
MONEY = DecimalType(MONEY_PRECISION, MONEY_SCALE)


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_zero(dtype: DecimalType = MONEY) -> Column:
    """A typed decimal zero, so defaulting never widens a money column to double."""
    return F.lit(Decimal(0)).cast(dtype)


def parse_decimal(c: ColumnOrName, dtype: DecimalType = MONEY) -> Column:
    """Trim, turn a decimal comma into a point and cast; bad text -> null.

    ``" 99,90"`` -> 99.90; ``"free"``, ``"R$10"`` and ``""`` -> null; the cast
    rounds half-up to the target scale.
    """
    return F.regexp_replace(F.trim(_col(c)), ",", ".").try_cast(dtype)


def parse_ts(c: ColumnOrName, formats: Sequence[str | None] = (None,)) -> Column:
    """Parse text to a timestamp, trying each layout in turn; none fit -> null.

    ``None`` in ``formats`` stands for the cast rules (ISO 8601).  The default
    accepts ISO only, so ``01/12/2025 05:57`` stays null unless
    ``DMY_MINUTES`` is listed.
    """
    col = _col(c)
    tries = [col.try_cast("timestamp") if f is None else F.try_to_timestamp(col, F.lit(f)) for f in formats]
    return tries[0] if len(tries) == 1 else F.coalesce(*tries)


def null_if(c: ColumnOrName, sentinel: str = NO_VALUE) -> Column:
    """Sentinel text (exact match; default ``NO_VALUE``) -> null, before any parsing."""
    return F.nullif(_col(c), F.lit(sentinel))


def strip_accents(c: ColumnOrName) -> Column:
    """Fold the accented Latin letters of ``ACCENTED`` to their base letter."""
    return F.translate(_col(c), ACCENTED, UNACCENTED)


def title_clean(c: ColumnOrName, accents: bool = True) -> Column:
    """trim -> strip accents -> lower -> initcap: ``' são PAULO'`` -> ``'Sao Paulo'``."""
    col = F.trim(_col(c))
    if accents:
        col = strip_accents(col)
    return F.initcap(F.lower(col))


def upper_trim(c: ColumnOrName) -> Column:
    return F.upper(F.trim(_col(c)))


def is_blank(c: ColumnOrName) -> Column:
    """Null, or empty after trimming.  Never null itself."""
    col = _col(c)
    return col.isNull() | (F.trim(col) == "")


def default_if_null(c: ColumnOrName, default, then: Callable[[Column], Column] | None = None) -> Column:
    """Null -> ``default``; otherwise ``then(c)`` (or ``c``).  Blank text stays."""
    col = _col(c)
    return F.when(col.isNull(), F.lit(default)).otherwise(then(col) if then else col)


def default_if_blank(c: ColumnOrName, default, then: Callable[[Column], Column] | None = None) -> Column:
    """Null or blank -> ``default``; otherwise ``then(c)`` (or ``c``)."""
    col = _col(c)
    return F.when(is_blank(col), F.lit(default)).otherwise(then(col) if then else col)


def null_if_negative(c: ColumnOrName) -> Column:
    """Negative -> null; null stays null."""
    col = _col(c)
    return F.when(col < 0, F.lit(None)).otherwise(col)


def zero_if_negative(c: ColumnOrName, zero: Column | None = None) -> Column:
    """Negative -> zero; null stays null.  Pass a typed ``zero`` to keep the type."""
    col = _col(c)
    return F.when(col < 0, zero if zero is not None else F.lit(0)).otherwise(col)


def zero_if_null(c: ColumnOrName, zero: Column | None = None) -> Column:
    """Null -> zero (a decimal zero for money, see ``money_zero``)."""
    return F.coalesce(_col(c), zero if zero is not None else F.lit(0))


def whole_units(c: ColumnOrName) -> Column:
    """Floor to a whole number of units, as int (2.7 -> 2, -0.5 -> -1)."""
    return F.floor(_col(c)).try_cast("int")


def ts_or_date(ts: ColumnOrName, d: ColumnOrName) -> Column:
    """Missing timestamp -> midnight of the fallback date."""
    return F.coalesce(_col(ts), _col(d).try_cast("timestamp"))


def ts_or_ts(a: ColumnOrName, b: ColumnOrName) -> Column:
    """First non-null of two timestamps (e.g. created, else ingested)."""
    return F.coalesce(_col(a), _col(b))


def hours_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole seconds from ``start`` to ``end`` / 3600, as double; null unless both set."""
    s, e = _col(start), _col(end)
    return F.when(s.isNotNull() & e.isNotNull(), (F.unix_timestamp(e) - F.unix_timestamp(s)) / 3600)
