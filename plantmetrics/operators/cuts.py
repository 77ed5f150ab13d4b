"""Cutting hot groups into even, ordered chunks from counts.

The chunk of a row follows from the row itself and from tables of counts: the values of the leading order column are
split into equal ranges, the rows of each range are counted, and neighbouring ranges are put together until a
chunk is full. Ranges that hold too much are split again, by the same column or, where it has one value only, by the
next one. So chunks come out the same however often they are computed, and nothing but counts has to be kept.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantmetrics.config import SizeLimits
from plantmetrics.sources.scratch import stage

CHUNK = "_chunk"
#: Ranges per chunk that a split makes.
_FINER = 4
_LARGEST = 1.7e308
#: Bytes of a text that tell its place.
_HEAD = 6


def _place(df: DataFrame, name: str) -> Column:
    """A double that never falls as the values of a column rise; NULL for NULL and for kinds that have none.

    Values with one place (longs beyond 2^53, texts with the same first bytes) can't be told apart, and share a range.
    """
    kind = df.schema[name].dataType
    value = F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.NumericType):
        number = value.cast("double")
        return F.when(F.isnan(number), F.lit(_LARGEST)).otherwise(F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), number)))
    if isinstance(kind, T.StringType):
        head = F.rpad(F.substring(F.hex(F.encode(value, "UTF-8")), 1, 2 * _HEAD), 2 * _HEAD, "0")
        return F.conv(head, 16, 10).cast("double")
    return F.lit(None).cast("double")


@dataclass(frozen=True)
class Cut:
    """``splits``: per level one row per range that is split there; ``chunks``: one row per range that isn't, with its
    chunk. ``axes``: how many of the order columns decide a row's chunk.
    """

    by: tuple[str, ...]
    order: tuple[str, ...]
    splits: tuple[DataFrame, ...]
    chunks: DataFrame | None
    axes: int
    n_ranges: int
    limits: SizeLimits

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_chunk``, numbered in order within each group; 0 in groups that aren't cut."""
        if self.chunks is None:
            return df.withColumn(CHUNK, F.lit(0))
        columns = df.columns
        for level, split in enumerate(self.splits):
            df = _ranged(df, split, self.by, self.order, level, self.limits, self.n_ranges)
        keys = [*self.by, *_cells(len(self.splits))]
        return _look_up(df, self.chunks, keys, [CHUNK], self.n_ranges, self.limits).select(
            *columns, F.coalesce(CHUNK, F.lit(0)).alias(CHUNK)
        )


def _cells(levels: int) -> list[str]:
    return [f"_cell{level}" for level in range(levels)]


def _look_up(
    df: DataFrame, table: DataFrame, keys: Sequence[str], values: Sequence[str], rows: int, limits: SizeLimits
) -> DataFrame:
    """Left join of a table of counts; sent to all while it is known to be small."""
    renamed = table.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], *values)
    if rows <= limits.broadcast_rows:
        renamed = F.broadcast(renamed)
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    return df.join(renamed, same, "left").drop(*[f"_key_{i}" for i in range(len(keys))])


def _ranged(
    df: DataFrame, split: DataFrame, by: Sequence[str], order: Sequence[str], level: int, limits: SizeLimits, rows: int
) -> DataFrame:
    """``df`` with its range at one more level: -1 where the value is NULL, 0 where nothing is split."""
    found = _look_up(df, split, [*by, *_cells(level)], ["_axis", "_low", "_high", "_parts"], rows, limits)
    place = F.lit(None).cast("double")
    for axis, name in enumerate(order):
        place = F.when(F.col("_axis") == axis, _place(df, name)).otherwise(place)
    low, high = F.col("_low") / 2, F.col("_high") / 2  # halves, as the whole span may be no double
    share = F.try_divide(place / 2 - low, high - low)
    number = F.least(F.col("_parts") - 1, F.greatest(F.lit(0), F.floor(share * F.col("_parts"))))
    cell = F.when(F.col("_axis").isNull(), 0).when(place.isNull(), -1).otherwise(F.coalesce(number, F.lit(0)))
    return found.withColumn(f"_cell{level}", cell.cast("long")).drop("_axis", "_low", "_high", "_parts")


def _counted(df: DataFrame, keys: Sequence[str], order: Sequence[str], limits: SizeLimits) -> DataFrame:
    """Rows per range, and by which column and between which places it can be split (``_axis`` NULL: by none)."""
    spans = []
    for i, name in enumerate(order):
        place, value = _place(df, name), F.col(name)
        known = F.count(value)
        one = F.min(value).eqNullSafe(F.max(value)) & ((known == 0) | (known == F.count(F.lit(1))))
        spans += [F.min(place).alias(f"_low{i}"), F.max(place).alias(f"_high{i}"), one.alias(f"_one{i}")]
        spans.append(((known > 0) & (F.count(place) < F.count(F.lit(1)))).alias(f"_null{i}"))
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *spans)
    axis, low, high = F.lit(None).cast("int"), F.lit(None).cast("double"), F.lit(None).cast("double")
    for i in reversed(range(len(order))):
        # several values: apart from each other, or one beside NULLs
        here, apart = ~F.col(f"_one{i}"), F.col(f"_low{i}") < F.col(f"_high{i}")
        axis = F.when(here, F.when(apart | F.col(f"_null{i}"), F.lit(i))).otherwise(axis)
        low = F.when(here, F.col(f"_low{i}")).otherwise(low)
        high = F.when(here, F.col(f"_high{i}")).otherwise(high)
    parts = F.ceil(F.col("_n") * F.lit(_FINER) / F.lit(limits.chunk_rows))
    split = counted.select(*keys, "_n", axis.alias("_axis"), low.alias("_low"), high.alias("_high"), parts.alias("_parts"))
    return split.withColumn("_axis", F.when(F.col("_n") > limits.chunk_rows, F.col("_axis")))


@dataclass(frozen=True)
class _Counts:
    """A table of counts, computed once: held by the driver while it is known to be small, else written."""

    df: DataFrame
    rows: list[Row] | None

    @classmethod
    def of(cls, df: DataFrame, n_rows: int, limits: SizeLimits) -> _Counts:
        if n_rows <= limits.broadcast_rows:
            return cls._local(df, df.collect())
        return cls(stage(df, "counts"), None)

    @classmethod
    def _local(cls, like: DataFrame, rows: list[Row], schema: T.StructType | None = None) -> _Counts:
        return cls(like.sparkSession.createDataFrame(rows, schema or like.schema).coalesce(1), rows)

    def empty(self) -> bool:
        return self.df.isEmpty() if self.rows is None else not self.rows

    def last_axis(self) -> int:
        """The last order column by which a range is split."""
        if self.rows is None:
            return self.df.agg(F.max("_axis")).first()[0]
        return max(row["_axis"] for row in self.rows)

    def where(self, split: bool) -> _Counts:
        """The ranges that are split further, or those that aren't."""
        if self.rows is None:
            return _Counts(self.df.where("_axis IS NOT NULL" if split else "_axis IS NULL"), None)
        return self._local(self.df, [row for row in self.rows if (row["_axis"] is not None) == split])


def _numbered(leaves: Sequence[_Counts], by: tuple[str, ...], cells: list[str], limits: SizeLimits) -> DataFrame:
    """The ranges that aren't split, each with its chunk: neighbours share one until it is full."""
    like = leaves[-1].df
    if all(leaf.rows is not None for leaf in leaves):
        groups: dict[tuple, list[tuple]] = defaultdict(list)
        for leaf in leaves:
            for row in leaf.rows:
                known = row.asDict()
                groups[tuple(row[name] for name in by)].append((*(known.get(cell, 0) for cell in cells), row["_n"]))
        found = []
        for group, ranges in groups.items():
            before = 0
            for *place, n in sorted(ranges):
                found.append((*group, *place, before // limits.chunk_rows + 1))
                before += n
        kind = T.StructType([like.schema[name] for name in by])
        for cell in cells:
            kind = kind.add(cell, T.LongType())
        return like.sparkSession.createDataFrame(found, kind.add(CHUNK, T.IntegerType())).coalesce(1)
    parts = [leaf.df.withColumns({cell: F.lit(0).cast("long") for cell in cells if cell not in leaf.df.columns}) for leaf in leaves]
    every = reduce(DataFrame.unionByName, [part.select(*by, *cells, "_n") for part in parts])
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy(*cells).rowsBetween(Window.unboundedPreceding, -1))
    chunk = (F.floor(F.coalesce(before, F.lit(0)) / F.lit(limits.chunk_rows)) + 1).cast("int")
    return every.select(*by, *cells, chunk.alias(CHUNK))


def cut_groups(
    df: DataFrame, by: Sequence[str], order: Sequence[str], rows: int, limits: SizeLimits = SizeLimits()
) -> Cut:
    """How to cut the groups of more than ``chunk_rows`` rows into chunks of up to about twice that.

    ``rows``: at least how many rows ``df`` has. Each level reads the key and order columns of ``df`` once; where values are spread evenly, one is enough.
    """
    by, order = tuple(by), tuple(order)
    # groups or ranges of more rows than a chunk, and the ranges a level splits these into
    n_ranges = (1 + _FINER) * (rows // limits.chunk_rows + 1)
    counts = _Counts.of(_counted(df, by, order, limits).where(F.col("_n") > limits.chunk_rows), n_ranges, limits)
    if counts.empty():
        return Cut(by, order, (), None, 0, 0, limits)
    splits, leaves, last = [], [], 0
    current, keys = df, list(by)
    while True:
        leaves.append(counts.where(split=False))
        dense = counts.where(split=True)
        if dense.empty():
            break
        level = len(splits)
        splits.append(dense.df)
        last = max(last, dense.last_axis())
        inside = _look_up(current, splits[-1], keys, [F.lit(True).alias("_dense")], n_ranges, limits).where("_dense")
        current = _ranged(inside.drop("_dense"), splits[-1], by, order, level, limits, n_ranges)
        keys = [*by, *_cells(level + 1)]
        counts = _Counts.of(_counted(current, keys, order, limits), n_ranges, limits)
    chunks = _numbered(leaves, by, _cells(len(splits)), limits)
    return Cut(by, order, tuple(splits), chunks, last + 1, n_ranges, limits)
