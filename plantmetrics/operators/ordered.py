"""Operators that walk each group in order: fill forward, look at the next row, accumulate.

Two plans give the same rows:

* ``window``: one task per group. Right while the largest group is known to be small.
* ``chunked``: hot groups are cut into even chunks of rows that follow each other. The chunk of a row follows
  from counts (see ``cuts``), so rows move once, to the partition of their (group, chunk). Each chunk is walked on
  its own, and what one hands to the next travels through a table of one row per (group, chunk).

``strategy="auto"`` counts the groups and picks. The order must be total within a group (end it with
a unique column), otherwise neither plan is deterministic.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantmetrics.config import SizeLimits
from plantmetrics.operators.cleaning import keep_first
from plantmetrics.operators.cuts import CHUNK, Cut, cut_groups
from plantmetrics.operators.sizing import GroupSizes, group_sizes


#: Rows that a task takes at least before more tasks are asked for: small chunks share one.
_TASK_ROWS = 250_000


@dataclass(frozen=True)
class OrderedRows:
    df: DataFrame
    by: tuple[str, ...]
    order: tuple[str, ...]
    chunked: bool
    handover_rows: int
    limits: SizeLimits

    def rows(self) -> Window:
        """Rows that one task walks, in order."""
        keys = (*self.by, CHUNK) if self.chunked else self.by
        return Window.partitionBy(*keys).orderBy(*self.order)

    def position(self) -> Column:
        return F.struct(*self.order)

    def hand_over(self, walked: DataFrame, summary: Sequence[Column], carried: Mapping[str, Column]) -> DataFrame:
        """Give every row of ``walked`` what the other chunks of its group say.

        ``summary`` aggregates one (group, chunk); ``carried`` combines these rows over the chunks
        of a group. The table in between has at most one row per group plus one per chunk.
        """
        # A digest of all columns keeps both readers of the moved rows alike, so that Spark moves them once. It is
        # never NULL; were the rows moved twice, the result would be the same.
        whole = F.bit_xor(F.xxhash64(*self.df.columns)).alias("_whole")
        per_chunk = self.df.groupBy(*self.by, CHUNK).agg(*summary, whole).where("_whole IS NOT NULL")
        keys = {name: f"_key_{i}" for i, name in enumerate((*self.by, CHUNK))}
        table = per_chunk.select(
            *[F.col(name).alias(key) for name, key in keys.items()],
            *[value.alias(name) for name, value in carried.items()],
        )
        if self.handover_rows <= self.limits.broadcast_rows:
            table = F.broadcast(table)
        same = [F.col(name).eqNullSafe(F.col(key)) for name, key in keys.items()]
        return walked.join(table, same, "left").drop(*keys.values())

    def chunks(self) -> Window:
        return Window.partitionBy(*self.by).orderBy(CHUNK)


def order_rows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    strategy: str = "auto",
    limits: SizeLimits = SizeLimits(),
    sizes: GroupSizes | None = None,
) -> OrderedRows:
    """Choose the plan for ``df``. ``sizes`` may come from a cheaper frame with at least these rows."""
    if strategy not in ("auto", "window", "chunked"):
        raise ValueError(f"unknown strategy {strategy!r}")
    by, order = tuple(by), tuple(order)
    if strategy != "window":
        sizes = sizes or group_sizes(df, by)
    if strategy == "window" or (strategy == "auto" and sizes.largest <= limits.max_group_rows):
        return OrderedRows(df, by, order, False, 0, limits)
    return _chunked(df, cut_groups(df, by, order, sizes.rows, limits), by, order, sizes, limits)


def _moved(df: DataFrame, keys: Sequence[str], rows: int, task_rows: int) -> DataFrame:
    """Rows in the partition of their keys; more partitions than configured if the counted rows call for it."""
    wanted = -(-rows // task_rows)
    if wanted <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(*keys)
    return df.repartition(wanted, *keys)


def _chunked(
    df: DataFrame, cut: Cut, by: tuple[str, ...], order: tuple[str, ...], sizes: GroupSizes, limits: SizeLimits
) -> OrderedRows:
    if cut.chunks is None:  # no group has more rows than a chunk
        return OrderedRows(_moved(df, by, sizes.rows, limits.chunk_rows), by, order, False, 0, limits)
    # a chunk is whole in a partition, and a partition holds as many chunks as make _TASK_ROWS
    moved = _moved(cut.apply(df), (*by, CHUNK), sizes.rows, max(limits.chunk_rows, _TASK_ROWS))
    return OrderedRows(moved, by, order, True, sizes.groups + cut.n_ranges, limits)


def order_unique(
    df: DataFrame,
    by: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    strategy: str = "auto",
    limits: SizeLimits = SizeLimits(),
) -> OrderedRows:
    """``order_rows`` of the first row (by the last of ``order``) of each combination of ``by`` and ``keys``.

    ``keys`` must decide the leading order column, so that copies are in one chunk: rows then move once, and
    copies are dropped where they meet. Only where a single value of that column has too many rows for a chunk,
    so that other order columns decide too, are copies dropped before, map-side, and rows move twice. Chunks
    are counted with the copies in both cases.
    """
    by, order = tuple(by), tuple(order)
    sizes = None if strategy == "window" else group_sizes(df, by)
    if strategy == "window" or (strategy == "auto" and sizes.largest <= limits.max_group_rows):
        moved = df.repartition(*by) if sizes is None else _moved(df, by, sizes.rows, limits.chunk_rows)
        return order_rows(keep_first(moved, [*by, *keys], order[-1:]), by, order, "window", limits)
    cut = cut_groups(df, by, order, sizes.rows, limits)
    if cut.axes > 1:
        return _chunked(keep_first(df, [*by, *keys], order[-1:]), cut, by, order, sizes, limits)
    rows = _chunked(df, cut, by, order, sizes, limits)
    within = (*by, CHUNK) if rows.chunked else by
    return replace(rows, df=keep_first(rows.df, [*within, *keys], order[-1:]))


def forward_fill(rows: OrderedRows, fills: Mapping[str, Column | str]) -> DataFrame:
    """Add each column of ``fills`` (new name -> source): the last non-NULL source value up to the row.

    Rows before the first value of their group stay NULL.
    """
    sources = {name: F.col(s) if isinstance(s, str) else s for name, s in fills.items()}
    up_to_row = rows.rows().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = rows.df.withColumns({n: F.last(s, ignorenulls=True).over(up_to_row) for n, s in sources.items()})
    if not rows.chunked:
        return filled
    summary = [
        F.max_by(s, F.when(s.isNotNull(), rows.position())).alias(f"_tail_{n}") for n, s in sources.items()
    ]
    earlier = rows.chunks().rowsBetween(Window.unboundedPreceding, -1)
    carried = {f"_carry_{n}": F.last(f"_tail_{n}", ignorenulls=True).over(earlier) for n in sources}
    joined = rows.hand_over(filled, summary, carried)
    completed = joined.withColumns({n: F.coalesce(F.col(n), F.col(f"_carry_{n}")) for n in sources})
    return completed.drop(CHUNK, *carried)


def next_value(rows: OrderedRows, source: str, name: str) -> DataFrame:
    """Add ``name``: the ``source`` value of the following row of the group, NULL on the last one."""
    if not rows.chunked:
        return rows.df.withColumn(name, F.lead(source).over(rows.rows()))
    walked = rows.df.withColumns(
        {
            name: F.lead(source).over(rows.rows()),
            "_is_last": F.lead(F.lit(True), 1, False).over(rows.rows()) == F.lit(False),
        }
    )
    summary = [F.min_by(source, rows.position()).alias("_head")]
    carried = {"_next_head": F.lead("_head").over(rows.chunks())}
    joined = rows.hand_over(walked, summary, carried)
    value = F.when(F.col("_is_last"), F.col("_next_head")).otherwise(F.col(name))
    return joined.withColumn(name, value).drop(CHUNK, "_is_last", "_next_head")


def running_total(rows: OrderedRows, source: str, name: str, total: str) -> DataFrame:
    """Add ``name``, the sum of ``source`` up to and including the row, and ``total``, that of its group."""
    up_to_row = rows.rows().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    walked = rows.df.withColumn(name, F.sum(source).over(up_to_row))
    whole = Window.partitionBy(*rows.by)
    if not rows.chunked:
        return walked.withColumn(total, F.sum(source).over(whole))
    summary = [F.sum(source).alias("_subtotal")]
    earlier = rows.chunks().rowsBetween(Window.unboundedPreceding, -1)
    carried = {
        "_before": F.coalesce(F.sum("_subtotal").over(earlier), F.lit(0)),
        total: F.sum("_subtotal").over(whole),
    }
    joined = rows.hand_over(walked, summary, carried)
    return joined.withColumn(name, F.col(name) + F.col("_before")).drop(CHUNK, "_before")


def with_position(
    df: DataFrame, order: Sequence[str], name: str = "position", limits: SizeLimits = SizeLimits()
) -> DataFrame:
    """``df`` plus each row's place, from 1, in a total order: it survives a write, which the order of rows doesn't."""
    alike = df.withColumns({"_all": F.lit(0), "_one": F.lit(1)})
    rows = order_rows(alike, ["_all"], order, "auto", limits)
    return running_total(rows, "_one", name, "_rows").drop("_all", "_one", "_rows")
