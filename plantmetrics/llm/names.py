"""Names of rows and of helper columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unused(df: DataFrame, *wanted: str) -> list[str]:
    """``wanted`` as column names, each with underscores put behind it until no column of ``df`` has it."""
    taken, found = {name.lower() for name in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def digests(*columns: str) -> tuple[Column, Column]:
    """Two independent digests of 64 bits: together a name of 128 bits for rows that are alike in ``columns``."""
    return F.xxhash64(*columns), F.xxhash64(F.lit("second"), *reversed(columns))
