"""Helper columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unused(name: str, *frames: DataFrame) -> str:
    """name, with underscores before it until no frame has such a column; case doesn't tell names apart."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def hashable(df: DataFrame) -> list[Column]:
    """All columns for a hash of the row; those that hold maps or variants, which have none, as JSON."""
    return [F.to_json(F.struct(c)) if "map<" in kind or "variant" in kind else F.col(c) for c, kind in df.dtypes]


def where_put(df: DataFrame, condition: Column) -> DataFrame:
    """df where condition holds, by a filter that Catalyst leaves where it stands.

    It would move it below what makes its columns, computing these twice, and below the
    repartition that deals one file over the cores, onto one of them. A filter doesn't
    pass a column that isn't deterministic; a number from 0 to less than 1, added to 0
    or 1, decides nothing.
    """
    flag = unused("stays", df)
    return df.withColumn(flag, F.rand() + condition.cast("int") >= 1).where(F.col(flag)).drop(flag)
