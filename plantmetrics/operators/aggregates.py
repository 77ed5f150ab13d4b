"""Aggregations behind reports and charts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantmetrics.config import SizeLimits
from plantmetrics.functions.numeric import stable_avg
from plantmetrics.operators.ordered import order_rows, running_total
from plantmetrics.operators.sizing import group_sizes
from plantmetrics.sources.scratch import stage


def category_counts(df: DataFrame, category: str, name: str = "count") -> DataFrame:
    return df.groupBy(category).agg(F.count(F.lit(1)).alias(name)).orderBy(category)


def pivot_table(
    df: DataFrame,
    index: str,
    columns: str,
    value: Column,
    labels: Sequence,
    fill: float | int | None = None,
    other: str | None = None,
) -> DataFrame:
    """One row per ``index``, one column per label of ``columns``, ``value`` aggregated in each cell.

    With ``other``, rows whose label is not listed (NULL included) go to a column of that name. Without it
    they have no cell; give it wherever the labels may not be all there are.
    """
    shown, names = columns, list(labels)
    if other is not None:
        listed = F.coalesce(F.col(columns).isin(names), F.lit(False))
        df = df.withColumn("_label", F.when(listed, F.col(columns).cast("string")).otherwise(F.lit(other)))
        shown, names = "_label", [*map(str, names), other]
    wide = df.groupBy(index).pivot(shown, names).agg(value)
    return wide if fill is None else wide.fillna(fill, subset=[c for c in wide.columns if c != index])


def group_means(df: DataFrame, by: str, columns: Sequence[str], scale: int | None = None) -> DataFrame:
    return df.groupBy(by).agg(*[stable_avg(c, scale).alias(c) for c in columns])


def side_by_side(*parts: DataFrame) -> DataFrame:
    """One row with the columns of several one-row frames."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def arg_max(df: DataFrame, by: str, value: str, at: str) -> DataFrame:
    """``at`` and ``value`` where ``value`` peaks in each group, the earliest ``at`` on a tie.

    NULL values never win; a group of only NULLs keeps NULLs.
    """
    value_known = F.when(F.col(value).isNotNull(), F.struct((-F.col(value)).alias("v"), F.col(at).alias("t")))
    peak = df.groupBy(by).agg(F.min_by(F.struct(at, value), value_known).alias("_peak"))
    return peak.select(by, f"_peak.{at}", f"_peak.{value}")


def quantiles(
    df: DataFrame,
    by: str,
    value: str,
    probabilities: Mapping[str, float],
    strategy: str = "auto",
    limits: SizeLimits = SizeLimits(),
) -> DataFrame:
    """Exact quantiles per group, interpolated linearly between neighbouring ranks; NaN counts as the largest value.

    Three plans give the same rows. ``window`` and ``chunked`` count equal values before any shuffle and find
    ranks on distinct values with a running count, by group or in chunks. ``selected`` never sorts: see
    ``selected_quantiles``. ``auto`` takes it where a group is hot, else ``window``.
    """
    known = df.select(by, value).where(F.col(value).isNotNull())  # dropna would take NaN too
    if strategy == "auto":
        hot = group_sizes(known, [by]).largest > limits.max_group_rows
        strategy = "selected" if hot else "window"
    if strategy == "selected":
        return selected_quantiles(known, by, value, probabilities, limits)
    counted = known.groupBy(by, value).agg(F.count(F.lit(1)).alias("_n"))
    # rows per group bound its distinct values and are counted before the shuffle
    sizes = None if strategy == "window" else group_sizes(known, [by])
    ordered = order_rows(counted, [by], [value], strategy, limits, sizes)
    ranked = running_total(ordered, "_n", "_end", "_rows")
    start = F.col("_end") - F.col("_n")

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((rank >= start) & (rank < F.col("_end")), F.col(value)))

    cells = [F.max("_rows").alias("n_values")]
    for name, probability in probabilities.items():
        position = (F.col("_rows") - 1) * F.lit(float(probability))
        cells.append(at_rank(F.floor(position)).alias(f"_low_{name}"))
        cells.append(at_rank(F.ceil(position)).alias(f"_high_{name}"))
    return _interpolated(ranked.groupBy(by).agg(*cells), by, probabilities)


def _interpolated(found: DataFrame, by: str, probabilities: Mapping[str, float]) -> DataFrame:
    """Quantiles from the values at the ranks below and above each (``_low_``, ``_high_``)."""
    columns = []
    for name, probability in probabilities.items():
        position = (F.col("n_values") - 1) * F.lit(float(probability))
        share = position - F.floor(position)
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        columns.append((low + (high - low) * share).alias(name))
    return found.select(by, "n_values", *columns)


#: Ranges that one pass of ``selected_quantiles`` counts per open range.
_RANGES = 256


def selected_quantiles(
    df: DataFrame, by: str, value: str, probabilities: Mapping[str, float], limits: SizeLimits = SizeLimits()
) -> DataFrame:
    """``quantiles`` without sorting or moving the values, for groups of any size.

    Each wanted rank is kept between two values. A pass over the table counts, map-side, the values in equal parts of
    these ranges; each rank then lies in one part, whose least and greatest value are its next range, until both are
    equal. So passes grow with the logarithm of the number of distinct values where they are spread evenly, and a
    pass sends at most 256 rows per task and open range.
    """
    number = F.col(value).cast("double")
    place = F.when(F.isnan(number), F.lit(float("inf"))).otherwise(number)
    bounded = F.greatest(F.lit(-1.7e308), F.least(F.lit(1.7e308), place))
    rows = df.where(number.isNotNull()).select(F.col(by).alias("_by"), number.alias("_v"), bounded.alias("_p"))
    span = [F.min("_p").alias("_from"), F.max("_p").alias("_to"), F.min("_v").alias("_value"), F.count(F.lit(1)).alias("_n")]
    ends = [f((F.col("_n") - 1) * F.lit(float(p))) for p in probabilities.values() for f in (F.floor, F.ceil)]
    groups = rows.groupBy("_by").agg(*span).withColumns({"n_values": F.col("_n"), "_skip": F.lit(0).cast("long")})
    wanted = groups.withColumn("_rank", F.explode(F.array_distinct(F.array(*ends))))
    done: list[DataFrame] = []
    while True:
        wanted = stage(wanted, "ranks")
        settled = F.col("_from") == F.col("_to")
        done.append(wanted.where(settled).select("_by", "n_values", "_rank", "_value"))
        open_ranks = wanted.where(~settled)
        n_open = open_ranks.count()
        if not n_open:
            break
        ranges = open_ranks.select(F.col("_by").alias("_key"), "_from", "_to").distinct()
        if n_open <= limits.broadcast_rows:
            ranges = F.broadcast(ranges)
        inside = F.col("_by").eqNullSafe(F.col("_key")) & F.col("_p").between(F.col("_from"), F.col("_to"))
        low, high = F.col("_from") / 2, F.col("_to") / 2  # halves, as the whole span may be no double
        part = F.least(F.lit(_RANGES - 1), F.floor((F.col("_p") / 2 - low) / (high - low) * _RANGES))
        counted = rows.join(ranges, inside).groupBy("_by", F.col("_from").alias("_start"), part.alias("_part")).agg(*span)
        so_far = Window.partitionBy("_by", "_start").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("_before", F.coalesce(F.sum("_n").over(so_far), F.lit(0))).alias("c")
        at = F.col("r._rank") - F.col("r._skip")
        same = F.col("r._by").eqNullSafe(F.col("c._by")) & (F.col("r._from") == F.col("c._start"))
        here = same & (at >= F.col("c._before")) & (at < F.col("c._before") + F.col("c._n"))
        wanted = open_ranks.alias("r").join(counted, here).select(
            "r._by", "c._from", "c._to", "c._value", "c._n", "r.n_values",
            (F.col("r._skip") + F.col("c._before")).alias("_skip"), "r._rank",
        )
    cells = []
    for name, probability in probabilities.items():
        position = (F.col("n_values") - 1) * F.lit(float(probability))
        for label, end in (("low", F.floor), ("high", F.ceil)):
            cells.append(F.max(F.when(F.col("_rank") == end(position), F.col("_value"))).alias(f"_{label}_{name}"))
    found = reduce(DataFrame.unionByName, done).groupBy(F.col("_by").alias(by), "n_values").agg(*cells)
    return _interpolated(found, by, probabilities)


def histogram(df: DataFrame, by: str, value: str, width: float, name: str = "n") -> DataFrame:
    """Counts per group and bin [k*width, (k+1)*width); ``bin`` is k."""
    bin_number = F.floor(F.col(value) / F.lit(width)).alias("bin")
    return df.dropna(subset=[value]).groupBy(by, bin_number).agg(F.count(F.lit(1)).alias(name))


def sample_rows(df: DataFrame, row_id: str, n: int, seed: int) -> DataFrame:
    """``n`` rows (all, if there are fewer) picked by a hash of id and seed: the same rows on every run."""
    pick = F.md5(F.concat_ws("-", F.col(row_id).cast("string"), F.lit(str(seed))))
    return df.orderBy(pick, row_id).limit(n)
