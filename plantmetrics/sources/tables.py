"""Raw file scans, layer tables and exports.

``fmt`` is any table format the session can write ("parquet" by default, "delta" or "iceberg"
where their jars are installed).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantmetrics.config import SizeLimits
from plantmetrics.operators.sizing import group_sizes

BAD_RECORD = "_bad_record"
_STRINGS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
#: Of layer tables, which are written once and read by several jobs.
_CODEC = "zstd"
#: Outside strings: what follows the end of an array or object where that isn't the end of the text.
_MORE_VALUES = r"[\]}]\s*[^\s,\]}]"
#: Values that name the folder of their partition as they are.
_PLAIN_VALUE = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    sampling_ratio: float = 1.0,
    bad_record: str | None = None,
) -> DataFrame:
    """CSV with a header line. Without a schema the types are inferred, at the price of one more pass.

    With a schema, columns are found by the names in the header, in any order; columns it doesn't name are
    left out, and a column that the header lacks is an error. All files of a folder must have the same
    header, else the read fails. ``bad_record`` names a further column with the text of a record that has a
    value of another type, or more or fewer values than the header; what could be read of it stays in the row.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).option("samplingRatio", sampling_ratio).csv(path)
    kinds = {field.name: field for field in schema}
    names = reader.csv(path).columns
    if missing := [name for name in kinds if name not in names]:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(names)}")
    ordered = T.StructType([kinds.get(name, T.StructField(name, T.StringType())) for name in names])
    reader = reader.option("enforceSchema", False).option("mode", "PERMISSIVE")
    if bad_record is None:
        return reader.schema(ordered).csv(path).select(*kinds)
    reader = reader.schema(ordered.add(bad_record, T.StringType())).option("columnNameOfCorruptRecord", bad_record)
    return reader.csv(path).select(*kinds, bad_record)


def read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    lines: bool = False,
    bad_record: str | None = None,
) -> DataFrame:
    """JSON array files, or JSON Lines with ``lines=True``; nothing is passed over in silence.

    The text is read once and parsed in the same pass (twice without a schema, which is inferred first). A file that
    is not one array of objects, or holds a second value behind it, fails the query, and so does an array on a line
    of JSON Lines. A line that can't be read or holds several values is a row of NULLs; ``bad_record`` names a further
    column with the text of such lines, and of those with a value of another type. Blank lines and files are no rows.

    One array file is one task, however large; feeds that grow should come as JSON Lines.
    """
    if schema is None:
        schema = spark.read.option("multiLine", not lines).json(path).schema
    if bad_record is not None:
        schema = T.StructType([*schema, T.StructField(bad_record, T.StringType())])
    options = {"columnNameOfCorruptRecord": bad_record} if bad_record else {}
    text, file = F.col("value"), F.col("_metadata.file_path")
    # what holds outside strings holds in the text too, where a string's quote stands for it: only texts that may have
    # more values are looked at without their strings
    bare = F.regexp_replace(text, _STRINGS, "0")
    more = F.when(text.rlike(_MORE_VALUES), bare.rlike(_MORE_VALUES)).otherwise(False)
    if lines:
        refused = F.raise_error(F.concat(file, F.lit(" is not JSON Lines"))).cast("boolean")
        # in the filter, which is evaluated whatever columns are asked for
        rows = spark.read.text(path).where(text.rlike(r"\S") & F.when(text.rlike(r"^\s*\["), refused).otherwise(True))
        # of several values on a line the parser would take the first
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name != bad_record]
        unread = F.struct(*nothing, *([text.alias(bad_record)] if bad_record else []))
        parsed = F.when(more, unread).otherwise(F.from_json(text, schema, options))
        return rows.select(parsed.alias("_row")).select("_row.*")
    files = spark.read.text(path, wholetext=True).where(text.rlike(r"\S"))
    wrong = ~text.rlike(r"^\s*\[") | more
    checked = F.when(wrong, F.raise_error(F.concat(file, F.lit(" is not a JSON array")))).otherwise(text)
    array = F.from_json(checked, T.ArrayType(schema), options)
    unread = F.raise_error(F.concat(file, F.lit(" is broken: not an array of objects")))
    return files.select(F.inline(F.coalesce(array, unread.cast(T.ArrayType(schema)))))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    constant: Mapping[str, str] | None = None,
) -> None:
    """Replace the table at ``path`` including its schema. ``path`` must not be an input of ``df``.

    ``constant`` gives the value of partition columns that are the same in all rows. Parquet files then go to the folder
    of that partition; a writer that looks for it row by row sorts each task's rows first, which spills.
    """
    known = constant or {}
    if fmt == "parquet" and partition_by and all(_PLAIN_VALUE.fullmatch(known.get(name, "")) for name in partition_by):
        files, target = _file(df.sparkSession, path)
        files.delete(target, True)
        folders = "/".join(f"{name}={known[name]}" for name in partition_by)
        write_table(df.drop(*partition_by), f"{path}/{folders}")
        return
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "parquet":
        writer = writer.option("compression", _CODEC)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_counted(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    without: str | None = None,
    constant: Mapping[str, str] | None = None,
    **metrics: Column,
) -> dict[str, int]:
    """``write_table`` that also returns ``rows`` and ``metrics`` (aggregates), gathered while the rows are written.

    The column ``without`` is there for the metrics and not written. No further job and no second read of the table.
    """
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(m.alias(name) for name, m in metrics.items()))
    write_table(observed.drop(without) if without else observed, path, fmt, partition_by, constant)
    found = seen.get
    return {name: found.get(name) or 0 for name in ("rows", *metrics)}


def write_bucketed(
    df: DataFrame, name: str, path: str, by: str, buckets: int, limits: SizeLimits = SizeLimits(), fmt: str = "parquet"
) -> bool:
    """Write a table of the catalog whose rows lie in ``buckets`` files by ``by``, so that grouping and joining on it
    need no shuffle later; whether it was done.

    A bucket is read by one task. So a table in which one value has more than ``max_group_rows`` rows is written
    plainly, and its readers spread it by shuffling what they have combined. Joins on ``by`` and further columns
    make use of buckets where ``spark.sql.requireAllClusterKeysForCoPartition`` is false.
    """
    even = group_sizes(df, [by]).largest <= limits.max_group_rows
    writer = df.repartition(buckets, by).write if even else df.write
    writer = writer.format(fmt).mode("overwrite").option("path", path)
    if even:
        writer = writer.bucketBy(buckets, by).sortBy(by)
    writer.saveAsTable(name)
    return even


def write_days(df: DataFrame, path: str, timestamp: str, day: str = "jour", fmt: str = "parquet") -> None:
    """Replace those days of the table at ``path`` that ``df`` has rows of, and leave its other days as they are.

    The table is partitioned by ``day``, the date of ``timestamp`` (NULL is a day too), which readers can filter on
    to read the files of some days only. Rows of one day come from several tasks, so a day may have several files.
    """
    dated = df.withColumn(day, F.to_date(timestamp))
    writer = dated.write.format(fmt).mode("overwrite").partitionBy(day)
    writer.option("partitionOverwriteMode", "dynamic").save(path)


def read_days(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None, day: str = "jour", fmt: str = "parquet"
) -> DataFrame:
    """Rows of the days from ``first`` to ``last`` (both included; without bounds all, those without a day too)."""
    df = read_table(spark, path, fmt)
    if first is not None:
        df = df.where(F.col(day) >= F.lit(first))
    if last is not None:
        df = df.where(F.col(day) <= F.lit(last))
    return df


def _file(spark: SparkSession, path: str):
    """(file system, path) on the driver, for the small files that mark finished tables."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def make_folder(spark: SparkSession, path: str) -> None:
    """The folder at ``path``, if it isn't there; an error where it can't be, as before a write that would find out last."""
    files, target = _file(spark, path)
    if not files.mkdirs(target):
        raise OSError(f"no folder can be made at {path}")


def write_marker(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced if it is there."""
    files, target = _file(spark, path)
    out = files.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_marker(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    files, target = _file(spark, path)
    if not files.exists(target):
        return None
    source = files.open(target)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def delete_marker(spark: SparkSession, path: str) -> None:
    files, target = _file(spark, path)
    files.delete(target, False)


def export_csv(df: DataFrame, path: str, compression: str = "none", rows_per_file: int = 0) -> None:
    """CSV part files with a header each, written by the executors.

    A compressed file is read by one task: ``rows_per_file`` makes more of them (0: one per task that writes). They
    are packed fast rather than small.
    """
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"').option("zlib.compress.level", "BEST_SPEED")
    writer.option("compression", compression).option("maxRecordsPerFile", rows_per_file).csv(path)


def preview(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order (a distributed top-n, not a full sort)."""
    return df.orderBy(*order_by).limit(n)
