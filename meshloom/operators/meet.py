"""Joins of tables whose size Spark can't foresee."""

from __future__ import annotations

from pyspark.sql import DataFrame


def meet(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """left.join(right) by sorting and merging, never by a broadcast.

    Spark's estimate of a table's size doesn't count the rows that explode() makes, and a compressed file is far smaller
    than its rows. So the vertices of a million meshes pass for a table that is small enough to go
    through the driver into every executor.
    """
    return left.join(right.hint("merge"), on, how)
