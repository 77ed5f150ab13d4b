"""Counting group sizes before an operator commits to a plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GroupSizes:
    rows: int
    groups: int
    largest: int


def group_sizes(df: DataFrame, by: Sequence[str]) -> GroupSizes:
    """Rows, groups and rows of the largest group.

    Reads the key columns only, and counts before the shuffle, so a hot key costs no more than others.
    """
    per_group = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    total = per_group.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.max("n"), F.lit(0)).alias("largest"),
    ).first()
    return GroupSizes(total["rows"], total["groups"], total["largest"])
