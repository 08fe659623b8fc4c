"""Looking at a table: the first rows by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def preview(df: DataFrame, order: Sequence[str], n: int = 130) -> DataFrame:
    """The first ``n`` rows in ``order`` (deterministic when ``order`` is a key).

    Planned as ``TakeOrderedAndProject``: each task keeps its own top ``n``
    and only those reach the final merge, so the table is never sorted or
    moved as a whole."""
    return df.orderBy(*order).limit(n)
