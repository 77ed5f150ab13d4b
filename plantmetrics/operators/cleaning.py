"""Deduplication, range flags, quality labels and defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantmetrics.config import INTERPOLATED, INVALID, LATE, ON_TIME, RUNNING, VALID, RangeRule
from plantmetrics.functions.numeric import any_true


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key combination: the lowest in ``order``, which must be unique within a key.

    Spark turns the rank filter into a per-partition limit before the shuffle, so of any number of
    copies each map task sends one.
    """
    rank = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(rank)).filter("_rank = 1").drop("_rank")


def out_of_range(rule: RangeRule) -> Column:
    """NULL for a missing reading, otherwise whether it breaks a bound (bounds themselves are valid)."""
    value = F.col(rule.column)
    breaks = []
    if rule.low is not None:
        breaks.append(value < rule.low)
    if rule.high is not None:
        breaks.append(value > rule.high)
    return any_true(breaks)


def flag_anomalies(df: DataFrame, rules: Sequence[RangeRule], flag: str = "anomalie_detectee") -> DataFrame:
    """One flag per rule and their three-valued OR: unknown unless some rule is certainly broken."""
    flagged = df.withColumns({rule.flag: out_of_range(rule) for rule in rules})
    return flagged.withColumn(flag, any_true([rule.flag for rule in rules]))


def anomaly_known(rules: Sequence[RangeRule]) -> Column:
    """Two-valued flag of the dashboards: a missing reading breaks no rule."""
    return any_true([F.coalesce(out_of_range(rule), F.lit(False)) for rule in rules])


def was_null(source: str, filled: str) -> Column:
    """Whether the fill supplied a value; still FALSE where there was none to supply."""
    return F.col(source).isNull() & F.col(filled).isNotNull()


def quality_label(anomaly: Column | str, was_filled: Column | str) -> Column:
    """INVALID before INTERPOLATED before VALID; an unknown anomaly is not INVALID."""
    anomaly = F.col(anomaly) if isinstance(anomaly, str) else anomaly
    was_filled = F.col(was_filled) if isinstance(was_filled, str) else was_filled
    return (
        F.when(anomaly, F.lit(INVALID)).when(was_filled, F.lit(INTERPOLATED)).otherwise(F.lit(VALID))
    )


def order_status(finished: Column | str, delay_hours: Column | str) -> Column:
    finished = F.col(finished) if isinstance(finished, str) else finished
    delay_hours = F.col(delay_hours) if isinstance(delay_hours, str) else delay_hours
    return (
        F.when(finished.isNull(), F.lit(RUNNING)).when(delay_hours > 0, F.lit(LATE)).otherwise(F.lit(ON_TIME))
    )


def threshold_status(value: Column | str, threshold: float, reached: str = "OK", missed: str = "KO") -> Column:
    """``reached`` at or above the threshold, ``missed`` below it, NULL for a NULL value."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value >= threshold, F.lit(reached)).when(value < threshold, F.lit(missed))


def fill_defaults(df: DataFrame, defaults: Mapping[str, float | int | str | bool]) -> DataFrame:
    """Replace NULLs left by an outer join, column by column."""
    return df.fillna(dict(defaults))


def add_lineage(df: DataFrame, source_file: str, source_system: str) -> DataFrame:
    """Ingestion time, origin and a row id that is unique but not consecutive.

    The id depends on the scan's partitions: write the table before anything relies on it.
    """
    # Names of the lineage columns.
    return df.withColumns(
        {
            "_ingestion_timestamp": F.current_timestamp(),
            "_source_file": F.lit(source_file),
            "_source_system": F.lit(source_system),
            "_row_id": F.monotonically_increasing_id(),
        }
    )
