"""Join of two event streams on a key and a time tolerance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.config import SizeLimits

_SLOT = "_slot"
_SPREAD = 1 << 20
#: Slots that are counted together before single ones.
_STRETCH = 64


class _Sides:
    """Both inputs, the right one with its key columns renamed, cut into time slots of one tolerance.

    A match is at most one slot away, so each right row appears in its own slot and both neighbours
    and each left row in one. Rows without key or time cannot match: right ones are dropped, left ones
    get a slot of their own below zero, spread by id so that they do not pile up in one task.
    """

    def __init__(self, left, right, by, left_ts, right_ts, tolerance_s, left_id):
        self.by = tuple(by)
        self.right_by = tuple(f"_right_{name}" for name in self.by)
        self.left_columns = left.columns
        self.right_columns = [c for c in right.columns if c not in self.by]
        overlap = set(self.left_columns) & set(self.right_columns)
        if overlap:
            raise ValueError(f"rename columns present on both sides: {sorted(overlap)}")
        self.left_ts, self.right_ts, self.tolerance_s = left_ts, right_ts, tolerance_s
        self.left = left
        self.right = right.withColumnsRenamed(dict(zip(self.by, self.right_by)))

        width = max(1, tolerance_s)
        slot = F.floor(F.unix_timestamp(left_ts) / F.lit(width))
        no_match = F.lit(-1) - F.pmod(F.xxhash64(left_id), F.lit(_SPREAD))
        known = [F.col(c).isNotNull() for c in (*self.by, left_ts)]
        usable = known[0]
        for condition in known[1:]:
            usable = usable & condition
        # An offset keeps real slots clear of the negative ones, also for times before 1970.
        offset = F.lit(1 << 40)
        self.left_slotted = left.withColumn(_SLOT, F.when(usable, slot + offset).otherwise(no_match))
        own = F.floor(F.unix_timestamp(right_ts) / F.lit(width)) + offset
        self.right_in_own = self.right.dropna(subset=[*self.right_by, right_ts]).withColumn("_own", own)
        nearby = F.array(F.col("_own") - 1, F.col("_own"), F.col("_own") + 1)
        self.right_slotted = self.right_in_own.withColumn(f"_right{_SLOT}", F.explode(nearby)).drop("_own")

    def hot_slots(self, limits: SizeLimits) -> int:
        """At most how many slots hold more than ``max_slot_rows`` rows of a side; 0 if none does.

        Right rows are counted where they are, not where they are copied to: three neighbours hold at
        most three times the fullest. Stretches of many slots are counted first, which combines well before
        the shuffle; where none of them is over the limit, no slot can be.
        """
        left = self.left_slotted.select(*self.by, _SLOT, F.lit(1).alias("_copies"))
        right = self.right_in_own.select(*self.right_by, "_own", F.lit(3).alias("_copies"))
        both = left.union(right)
        stretch = F.floor(F.col(_SLOT) / F.lit(_STRETCH)).alias("_stretch")
        per_stretch = both.groupBy(*self.by, stretch, "_copies").agg(F.sum("_copies").alias("n"))
        if (per_stretch.agg(F.max("n")).first()[0] or 0) <= limits.max_slot_rows:
            return 0
        per_slot = both.groupBy(*self.by, _SLOT, "_copies").agg(F.sum("_copies").alias("n"))
        return per_slot.where(F.col("n") > limits.max_slot_rows).agg(F.sum("_copies")).first()[0] or 0

    def same_key(self) -> Column:
        condition = F.lit(True)
        for mine, theirs in zip(self.by, self.right_by):
            condition = condition & (F.col(mine) == F.col(theirs))
        return condition

    def same_slot(self) -> Column:
        return self.same_key() & (F.col(_SLOT) == F.col(f"_right{_SLOT}"))

    def close(self, right_seconds: Column) -> Column:
        return F.abs(F.unix_timestamp(self.left_ts) - right_seconds) <= self.tolerance_s

    def output(self, joined: DataFrame) -> DataFrame:
        return joined.select(*self.left_columns, *self.right_columns)


def range_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    tolerance_s: int,
    left_id: str,
    right_id: str,
    how: str = "left",
    strategy: str = "auto",
    limits: SizeLimits = SizeLimits(),
) -> DataFrame:
    """Every pair with equal ``by`` and times at most ``tolerance_s`` whole seconds apart.

    A left row with several matches appears once per match; with ``how="left"`` one without any stays,
    its right columns NULL. ``left_id`` and ``right_id`` are unique and only serve to spread hot rows.

    * ``naive``: join on ``by``, test the times afterwards. Compares all rows of a key.
    * ``slotted``: join on (``by``, time slot). Compares rows at most two tolerances apart.
    * ``salted``: as slotted, with the slots above ``limits.max_slot_rows`` cut into a grid of smaller joins.
    * ``auto``: slotted, or salted if counting finds such a slot.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    if strategy not in ("auto", "naive", "slotted", "salted"):
        raise ValueError(f"unknown strategy {strategy!r}")
    sides = _Sides(left, right, by, left_ts, right_ts, tolerance_s, left_id)
    right_seconds = F.unix_timestamp(right_ts)
    if strategy == "naive":
        return sides.output(sides.left.join(sides.right, sides.same_key() & sides.close(right_seconds), how))
    hot = 0 if strategy == "slotted" else sides.hot_slots(limits)
    if strategy == "auto":
        strategy = "salted" if hot else "slotted"
    if strategy == "slotted":
        near = sides.same_slot() & sides.close(right_seconds)
        return sides.output(sides.left_slotted.join(sides.right_slotted, near, how))
    return _salted_join(sides, left_id, right_id, how, limits.max_slot_rows, hot <= limits.broadcast_rows)


def _salted_join(sides: _Sides, left_id: str, right_id: str, how: str, size: int, few: bool) -> DataFrame:
    """Cut the slots with more than ``size`` rows of a side into bands of about that many.

    A left row is in one band and copied across the right bands, a right row the other way round, so
    each pair meets in exactly one cell. Copies would repeat unmatched left rows, hence the cells are
    inner joins and unmatched rows come from an anti join against the distinct seconds of the right
    side, of which a slot has at most three tolerances' worth. The table of bands is broadcast if the
    slots to be cut are ``few``; otherwise it meets the rows in a shuffle, where adaptive execution splits
    the partitions of hot slots.
    """
    slot_keys = [*sides.by, _SLOT]
    right_keys = [*sides.right_by, f"_right{_SLOT}"]

    def bands(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        counted = df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("int").alias(name))
        return counted.toDF(*[f"_hot_{i}" for i in range(len(keys))], name).filter(F.col(name) > 1)

    hot_keys = [f"_hot_{i}" for i in range(len(slot_keys))]
    hot = (
        bands(sides.left_slotted, slot_keys, "_left_bands")
        .join(bands(sides.right_slotted, right_keys, "_right_bands"), hot_keys, "full")
        .fillna({"_left_bands": 1, "_right_bands": 1})
    )
    if few:
        hot = F.broadcast(hot)

    def with_bands(df: DataFrame, keys: list[str]) -> DataFrame:
        same = [F.col(key) == F.col(h) for key, h in zip(keys, hot_keys)]
        return df.join(hot, same, "left").drop(*hot_keys).fillna({"_left_bands": 1, "_right_bands": 1})

    def copies(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    def band(row_id: str, count: str) -> Column:
        return F.pmod(F.xxhash64(row_id), F.col(count)).cast("int")

    left = with_bands(sides.left_slotted, slot_keys).withColumn("_left_band", band(left_id, "_left_bands"))
    right = with_bands(sides.right_slotted, right_keys)
    right_grid = (
        right.withColumn("_right_band", band(right_id, "_right_bands"))
        .withColumn("_for_left_band", copies("_left_bands"))
        .drop("_left_bands", "_right_bands")
    )
    left_grid = left.withColumn("_for_right_band", copies("_right_bands"))
    cell = (
        sides.same_slot()
        & (F.col("_left_band") == F.col("_for_left_band"))
        & (F.col("_for_right_band") == F.col("_right_band"))
    )
    near = cell & sides.close(F.unix_timestamp(sides.right_ts))
    matched = sides.output(left_grid.join(right_grid, near, "inner"))
    if how == "inner":
        return matched

    seconds = (
        with_bands(
            sides.right_slotted.select(*right_keys, F.unix_timestamp(sides.right_ts).alias("_seconds")).distinct(),
            right_keys,
        )
        .withColumn("_for_left_band", copies("_left_bands"))
        .drop("_left_bands", "_right_bands")
    )
    in_band = sides.same_slot() & (F.col("_left_band") == F.col("_for_left_band"))
    alone = left.join(seconds, in_band & sides.close(F.col("_seconds")), "left_anti")
    kinds = {field.name: field.dataType for field in sides.right.schema.fields}
    empty = [F.lit(None).cast(kinds[name]).alias(name) for name in sides.right_columns]
    return matched.unionByName(alone.select(*sides.left_columns, *empty))
