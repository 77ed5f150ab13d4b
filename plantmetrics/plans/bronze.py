"""Raw files to bronze tables: declared types plus lineage columns, nothing cleaned."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantmetrics import schemas
from plantmetrics.config import SizeLimits
from plantmetrics.operators.cleaning import add_lineage
from plantmetrics.sources.tables import BAD_RECORD, read_csv, read_json, write_counted, write_table


@dataclass(frozen=True)
class Source:
    table: str
    file: str
    system: str
    schema: T.StructType
    read: Callable[..., DataFrame]


# File and system names of the four plant feeds.
SOURCES: tuple[Source, ...] = (
    Source("sensors", "sensors_data.csv", "IOT", schemas.SENSORS, read_csv),
    Source("scada", "scada_logs.json", "SCADA", schemas.SCADA, read_json),
    Source("mes", "mes_orders.csv", "MES", schemas.MES, read_csv),
    Source("maintenance", "maintenance_logs.csv", "MAINTENANCE", schemas.MAINTENANCE, read_csv),
)


def sources(scada_lines: bool = False) -> tuple[Source, ...]:
    """The feeds, with the state events as one JSON array per file or, splittable, as JSON Lines."""
    lines = partial(read_json, lines=True)
    return tuple(replace(s, read=lines) if scada_lines and s.table == "scada" else s for s in SOURCES)


def feed_files(spark: SparkSession, path: str) -> list[tuple[str, int, str]]:
    """(path, bytes, time of change) of a feed's files in path order, from their listing alone: no file is opened."""
    about = F.col("_metadata")
    listed = spark.read.format("binaryFile").load(path).select(
        about["file_path"], about["file_size"], about["file_modification_time"].cast("string")
    )
    return sorted(tuple(row) for row in listed.collect())


def _bytes(text: str) -> int:
    """A size setting in bytes: a number, or one with a unit."""
    digits = text.rstrip("bBkKmMgGtT")
    unit = text[len(digits) :].lower().rstrip("b")
    return int(digits) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def feed_row_ids(spark: SparkSession, rows: DataFrame, path: str, broadcast_rows: int) -> DataFrame:
    """``rows`` of the feed at ``path`` with ``_row_id`` in feed order: by file path, place in the file, and row.

    A task holds whole pieces of files one after the other, so its own row numbers tell the order within a piece.
    Pieces are numbered by what the listing says: each is at least ``least`` bytes away from the one before it, so
    (bytes of the files before it + own place) in units of ``least`` gives each a number of its own.
    """
    conf = spark.conf
    least = min(_bytes(conf.get(f"spark.sql.files.{name}")) for name in ("openCostInBytes", "maxPartitionBytes"))
    first, pieces = 0, []
    for file, size, _ in feed_files(spark, path):
        pieces.append((file, first))
        first += max(1, -(-size // least))
    numbered = spark.createDataFrame(pieces, "_path string, _first long")
    if len(pieces) <= broadcast_rows:
        numbered = F.broadcast(numbered)
    place = {
        "_path": F.col("_metadata.file_path"),
        "_piece": F.floor(F.col("_metadata.file_block_start") / F.lit(least)),
        "_within": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    }
    placed = rows.withColumns(place).join(numbered, "_path", "left")
    unlisted = F.raise_error(F.concat("_path", F.lit(" came after the feed was listed"))).cast("long")
    row_id = F.shiftleft(F.coalesce("_first", unlisted) + F.col("_piece"), 33) + F.col("_within")
    return placed.withColumn("_row_id", row_id).select(*rows.columns, "_row_id")


def read_feed(spark: SparkSession, source: Source, raw_dir: str, limits: SizeLimits = SizeLimits()) -> DataFrame:
    """``ingest`` plus ``_bad_record``: the text of a record that could not be read as declared, else NULL."""
    path = f"{raw_dir}/{source.file}"
    rows = add_lineage(source.read(spark, path, source.schema, bad_record=BAD_RECORD), source.file, source.system)
    names = [name for name in rows.columns if name not in ("_row_id", BAD_RECORD)]
    return feed_row_ids(spark, rows.drop("_row_id"), path, limits.broadcast_rows).select(*names, "_row_id", BAD_RECORD)


def ingest(spark: SparkSession, source: Source, raw_dir: str, limits: SizeLimits = SizeLimits()) -> DataFrame:
    """Rows of one feed with lineage; the feed may be one file or a folder of part files.

    Records that could not be read as declared stay, with what could be read of them. One scan of the feed.
    """
    return read_feed(spark, source, raw_dir, limits).drop(BAD_RECORD)


def bad_rows(feed: DataFrame) -> DataFrame:
    """The records of ``read_feed`` that could not be read as declared, with their text."""
    return feed.where(F.col(BAD_RECORD).isNotNull())


def store_feed(
    feed: DataFrame, path: str, bad_path: str, fmt: str = "parquet", keep_bad: bool = True, system: str | None = None
) -> dict[str, int]:
    """Write a feed's bronze table and its bad records; return how many ``rows`` and ``bad`` ones there are.

    Both are counted while the table is written. Only a feed that has bad records is read once more, for these. With
    ``keep_bad`` they are in both tables, as far as they could be read, else in that of the bad records alone.
    ``system`` is the feed's ``_source_system`` where known: its rows then need no sort before they are written.
    """
    wrong = F.col(BAD_RECORD).isNotNull()
    counts = {"bad": F.count(F.when(wrong, 1))}
    partition = ["_source_system"]
    one = {"_source_system": system} if system else None
    if keep_bad:
        found = write_counted(feed, path, fmt, partition, without=BAD_RECORD, constant=one, **counts)
    else:
        seen = Observation()
        kept = feed.observe(seen, counts["bad"].alias("bad")).where(~wrong)
        found = write_counted(kept, path, fmt, partition, without=BAD_RECORD, constant=one)
        found |= {"bad": seen.get.get("bad") or 0}
    if found["bad"]:
        write_table(bad_rows(feed), bad_path, fmt)
    else:
        write_table(feed.sparkSession.createDataFrame([], feed.schema), bad_path, fmt)
    return found


def write_bronze(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(df, path, fmt, partition_by=["_source_system"])
