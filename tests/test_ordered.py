import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plantmetrics.config import SizeLimits
from plantmetrics.operators.cleaning import keep_first
from plantmetrics.operators.ordered import (
    CHUNK,
    forward_fill,
    next_value,
    order_rows,
    order_unique,
    running_total,
    with_position,
)
from plantmetrics.operators.sizing import group_sizes

TINY = SizeLimits(max_group_rows=10, chunk_rows=37)


def skewed(spark, n=3000):
    """A third of the rows in one group; unknown groups, unknown times, equal times and gaps."""
    i = F.col("id")
    return spark.range(n, numPartitions=5).select(
        i.alias("row_id"),
        F.when(i % 3 == 0, "hot").when(i % 31 == 0, None).otherwise(F.concat(F.lit("m"), i % 17)).alias("m"),
        F.when(i % 11 != 0, F.timestamp_seconds((i * 7919) % 2000)).alias("ts"),
        F.when(i % 5 == 1, i.cast("double")).alias("v"),
        F.when(i % 211 == 7, i).alias("rare"),
    )


def both(spark, operator, df=None, **options):
    df = skewed(spark) if df is None else df
    return [operator(order_rows(df, ["m"], ["ts", "row_id"], s, TINY), **options) for s in ("window", "chunked")]


def test_forward_fill_of_one_machine(spark):
    rows = [("a", 1, None), ("a", 2, 5.0), ("a", 3, None), ("a", 4, None), ("a", 5, 7.0), ("b", 1, None)]
    df = spark.createDataFrame(rows, "m string, t long, v double")
    for strategy in ("window", "chunked"):
        ordered = order_rows(df, ["m"], ["t"], strategy, SizeLimits(chunk_rows=2))
        filled = forward_fill(ordered, {"f": "v"}).orderBy("m", "t")
        assert [r.f for r in filled.collect()] == [None, 5.0, 5.0, 5.0, 7.0, None]


def test_forward_fill_plans_agree(spark, same_rows):
    window, chunked = both(spark, forward_fill, fills={"v_filled": "v", "rare_filled": "rare"})
    assert window.columns == chunked.columns
    same_rows(window, chunked)


def test_next_value_plans_agree(spark, same_rows):
    same_rows(*both(spark, next_value, source="ts", name="next_ts"))


def test_next_value_when_the_following_one_is_unknown(spark, same_rows):
    df = skewed(spark, 600).withColumn("ts", F.when(F.col("row_id") % 2 == 0, F.col("ts")))
    same_rows(*both(spark, next_value, df, source="ts", name="next_ts"))


def test_running_total_plans_agree(spark, same_rows):
    window, chunked = both(spark, running_total, source="row_id", name="so_far", total="whole")
    same_rows(window, chunked)
    sums = window.groupBy("m").agg(F.max("so_far").alias("a"), F.max("whole").alias("b"), F.sum("row_id").alias("c"))
    assert sums.filter("a <> b OR b <> c").count() == 0


def test_handover_through_a_shuffle_join(spark, same_rows):
    limits = SizeLimits(max_group_rows=10, chunk_rows=37, broadcast_rows=0)
    window = forward_fill(order_rows(skewed(spark), ["m"], ["ts", "row_id"], "window"), {"f": "v"})
    chunked = forward_fill(order_rows(skewed(spark), ["m"], ["ts", "row_id"], "chunked", limits), {"f": "v"})
    same_rows(window, chunked)


def test_chunks_are_even_although_one_group_is_hot(spark):
    ordered = order_rows(skewed(spark), ["m"], ["ts", "row_id"], "auto", SizeLimits(max_group_rows=100, chunk_rows=100))
    assert ordered.chunked
    counts = [r["count"] for r in ordered.df.groupBy("m", CHUNK).count().collect()]
    assert len(counts) > 20 and max(counts) < 400 and sum(counts) == 3000


def test_small_chunks_share_tasks(spark):
    """The number of tasks follows from rows, not from chunks."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for limits in (TINY, SizeLimits(max_group_rows=10, chunk_rows=2)):
        ordered = order_rows(skewed(spark), ["m"], ["ts", "row_id"], "chunked", limits)
        assert ordered.chunked and ordered.df.rdd.getNumPartitions() <= tasks
        unique = order_unique(skewed(spark), ["m"], ["ts"], ["ts", "row_id"], "chunked", limits)
        assert unique.chunked and unique.df.rdd.getNumPartitions() <= tasks


def test_chunks_follow_the_order_whatever_the_values_are(spark):
    """One instant and unknown times with many rows, values far apart, texts, and copies of the whole order."""
    i = F.col("id")
    crowded = F.when(i % 4 == 0, F.lit(1700000000)).when(i % 4 == 1, None).otherwise(i * i * i)
    cases = {
        "crowded": F.timestamp_seconds(crowded),
        "skewed": F.exp(i.cast("double") / 100) - 3,
        "odd": F.when(i % 3 == 0, float("nan")).when(i % 3 == 1, float("-inf")).otherwise(i.cast("double")),
        "text": F.concat(F.lit("x"), (i % 50).cast("string")),
        "day": F.date_add(F.lit("2024-01-01").cast("date"), (i % 9).cast("int")),
        "large": F.lit(1 << 62) + i,
        "same": F.lit("always"),
    }
    for broadcast_rows in (200_000, 0):
        limits = SizeLimits(max_group_rows=100, chunk_rows=50, broadcast_rows=broadcast_rows)
        for name, value in cases.items():
            df = spark.range(2000, numPartitions=2).select(F.when(i % 2 == 0, "a").alias("m"), value.alias("v"), i.alias("row_id"))
            found = order_rows(df, ["m"], ["v", "row_id"], "chunked", limits).df
            sizes = [r["count"] for r in found.groupBy("m", CHUNK).count().collect()]
            # longs that are one and the same as doubles stay together
            assert sum(sizes) == 2000 and (max(sizes) <= 101 or name == "large"), (name, max(sizes))
            place = Window.partitionBy("m").orderBy("v", "row_id")
            falls = found.withColumn("before", F.lag(CHUNK).over(place)).where(F.col("before") > F.col(CHUNK))
            assert falls.isEmpty(), name
            if broadcast_rows == 0:  # tables of counts are written
                break


def test_rows_move_once(spark):
    rows = order_rows(skewed(spark), ["m"], ["ts", "row_id"], "chunked", TINY)
    filled = forward_fill(rows, {"f": "v"})
    filled.collect()
    plan = filled._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(m#" in line and "_chunk" in line and "Reused" not in line]
    assert len([line for line in moved if "REPARTITION" in line]) == 1
    assert "parquet" not in plan.lower()


def test_unique_rows_in_chunks(spark, same_rows):
    """Copies drop out where they meet; with a crowded instant before that. Always the first copy stays."""
    i = F.col("id")
    for instant in (i % 700, F.when(i % 2 == 0, 0).otherwise(i % 700)):
        df = spark.range(4000, numPartitions=4).select(
            F.when(i % 3 != 0, "hot").otherwise(F.concat(F.lit("m"), i % 7)).alias("m"),
            instant.alias("t"), (i % 2).alias("kind"), i.alias("row_id"), (i * 3).alias("v"),
        )
        for strategy in ("auto", "chunked"):
            found = order_unique(df, ["m"], ["t", "kind"], ["t", "row_id"], strategy, SizeLimits(max_group_rows=200, chunk_rows=150))
            wanted = keep_first(df, ["m", "t", "kind"], ["row_id"])
            same_rows(wanted, found.df)
            window = order_unique(df, ["m"], ["t", "kind"], ["t", "row_id"], "window")
            same_rows(next_value(window, "v", "next"), next_value(found, "v", "next"))


def test_positions(spark):
    df = spark.range(1000, numPartitions=5).select((F.col("id") * 7919 % 1000).alias("x"), F.lit("y").alias("z"))
    for limits in (SizeLimits(), SizeLimits(max_group_rows=10, chunk_rows=40)):
        placed = with_position(df, ["x"], limits=limits)
        assert placed.columns == ["x", "z", "position"]
        assert all(r.position == r.x + 1 for r in placed.collect())


def test_auto_keeps_small_groups_whole(spark):
    assert not order_rows(skewed(spark), ["m"], ["ts"], "auto").chunked
    with pytest.raises(ValueError):
        order_rows(skewed(spark), ["m"], ["ts"], "fast")


def test_group_sizes(spark):
    sizes = group_sizes(skewed(spark), ["m"])
    assert (sizes.rows, sizes.largest) == (3000, 1000)
    empty = group_sizes(skewed(spark).limit(0), ["m"])
    assert (empty.rows, empty.groups, empty.largest) == (0, 0, 0)


def test_empty_input(spark):
    empty = skewed(spark).limit(0)
    for frame in both(spark, forward_fill, empty, fills={"f": "v"}):
        assert frame.count() == 0
