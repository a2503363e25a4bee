"""Adding only what isn't there yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_rows(incoming: DataFrame, existing: DataFrame, key: str = "id") -> DataFrame:
    """Rows of incoming whose key existing doesn't have; null keys are always new."""
    known = existing.where(F.col(key).isNotNull()).select(key).distinct()
    return incoming.join(known, key, "left_anti").select(*incoming.columns)


def append_new(existing: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """existing and what is new in incoming; doing it again adds nothing."""
    return existing.unionByName(new_rows(incoming, existing, key), allowMissingColumns=True)
