import pytest
from pyspark.sql import functions as F

from plantmetrics.config import SizeLimits
from plantmetrics.operators.joins import _Sides, range_join

STRATEGIES = ("naive", "slotted", "salted", "auto")
TINY = SizeLimits(max_slot_rows=8)


def join(left, right, strategy, how="left", tolerance_s=300, limits=TINY):
    return range_join(left, right, ["m"], "ts", "event_ts", tolerance_s, "id", "event_id", how, strategy, limits)


def frames(spark, left, right):
    lefts = spark.createDataFrame(left, "id long, m string, s long").selectExpr("id", "m", "timestamp_seconds(s) AS ts")
    rights = spark.createDataFrame(right, "event_id long, m string, s long").selectExpr(
        "event_id", "m", "timestamp_seconds(s) AS event_ts"
    )
    return lefts, rights


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_tolerance_is_inclusive_and_matches_multiply(spark, strategy):
    left = [(1, "a", 1000), (2, "a", 2000), (3, "b", 1000), (4, None, 1000), (5, "a", None), (6, "a", -700)]
    right = [(1, "a", 1300), (2, "a", 1301), (3, "a", 700), (4, "c", 1000), (5, None, 1000), (6, "a", None), (7, "a", -1000)]
    found = join(*frames(spark, left, right), strategy).select("id", "event_id").collect()
    expected = [(1, 1), (1, 3), (2, None), (3, None), (4, None), (5, None), (6, 7)]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def skewed(spark):
    """A third of each side in one five-minute slot of one machine, with equal times and unknown keys."""
    i = F.col("id")

    def side(n, key, ts, factor):
        hot = i % 3 == 0
        return spark.range(n, numPartitions=3).select(
            i.alias(key),
            F.when(hot, "hot").when(i % 37 == 1, None).otherwise(F.concat(F.lit("m"), i % 4)).alias("m"),
            F.when(hot, F.timestamp_seconds(60000 + i % 40))
            .when(i % 41 == 1, None)
            .otherwise(F.timestamp_seconds((i * factor) % 90000))
            .alias(ts),
        )

    return side(400, "id", "ts", 7919), side(150, "event_id", "event_ts", 6007)


@pytest.mark.parametrize("how,tolerance_s", [("left", 0), ("inner", 17), ("left", 300), ("left", 7200)])
def test_strategies_agree_on_skewed_sides(spark, same_rows, how, tolerance_s):
    left, right = skewed(spark)
    naive = join(left, right, "naive", how, tolerance_s)
    for strategy in ("slotted", "salted", "auto"):
        other = join(left, right, strategy, how, tolerance_s)
        assert other.columns == naive.columns
        same_rows(naive, other)


def test_left_rows_are_preserved(spark):
    left, right = skewed(spark)
    joined = join(left, right, "salted")
    assert joined.select("id").distinct().count() == left.count()


def test_every_hot_slot_is_cut_however_many(spark, same_rows):
    left, right = skewed(spark)
    sides = _Sides(left, right, ["m"], "ts", "event_ts", 300, "id")
    assert sides.hot_slots(SizeLimits()) == 0
    assert 0 < sides.hot_slots(TINY) < sides.hot_slots(SizeLimits(max_slot_rows=2))
    few = SizeLimits(max_slot_rows=2, broadcast_rows=4)
    assert sides.hot_slots(few) > few.broadcast_rows
    same_rows(join(left, right, "naive"), join(left, right, "salted", limits=few))


def test_a_hot_slot_is_found_at_the_limit(spark):
    left, right = frames(spark, [(k, "a", 900) for k in range(5)], [(1, "a", 90000)])
    sides = _Sides(left, right, ["m"], "ts", "event_ts", 300, "id")
    assert [sides.hot_slots(SizeLimits(max_slot_rows=n)) for n in (4, 5)] == [1, 0]


def test_no_pairwise_plan(spark):
    left, right = skewed(spark)
    for strategy in ("slotted", "salted"):
        plan = join(left, right, strategy)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_bad_arguments(spark):
    left, right = skewed(spark)
    with pytest.raises(ValueError):
        join(left, right, "fast")
    with pytest.raises(ValueError):
        join(left, right, "naive", how="full")
    with pytest.raises(ValueError):
        join(left, right.withColumn("id", F.lit(1)), "naive")
