"""Small helpers for operators that work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


#: What operators keep in a worker from task to task, by operator, and how it is let go.
_kept: dict[str, Callable[[], None]] = {}


def keep_in_worker(owner: str, let_go: Callable[[], None]) -> None:
    """Say that ``owner`` keeps something in this process, which lives longer than its tasks."""
    _kept[owner] = let_go


def begin_task(owner: str | None = None) -> None:
    """Let go of what other operators kept in this process: a worker then never holds the caches of two."""
    for name in [name for name in _kept if name != owner]:
        _kept.pop(name)()


def in_slices(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of about ``size`` bytes at most (or one row)."""
    for batch in batches:
        rows = max(1, batch.num_rows * size // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def batch_mapper(
    work: Callable[..., Sequence], schema: StructType, owner: str | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lift ``work`` (one Python list per input column -> one sequence per output column) to Arrow batches."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task(owner)
        for batch in batches:
            if batch.num_rows:
                columns = work(*(column.to_pylist() for column in batch.columns))
                yield record_batch(columns, arrow)

    return run


def record_batch(columns: Sequence, arrow: pa.Schema) -> pa.RecordBatch:
    arrays = [
        column if isinstance(column, pa.Array) else pa.array(column, type=field.type)
        for column, field in zip(columns, arrow, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=arrow)


def map_columns(df: DataFrame, work: Callable[..., Sequence], schema: str, owner: str | None = None) -> DataFrame:
    """``df`` through ``work``, one Arrow batch at a time; ``schema`` is the DDL of the result. ``owner``: whose kept
    caches (``keep_in_worker``) the tasks may go on with."""
    kind = StructType.fromDDL(schema)
    return df.mapInArrow(batch_mapper(work, kind, owner), kind)
