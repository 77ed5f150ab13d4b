from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plantmetrics.functions import (
    any_true,
    clamp,
    hours_between,
    label_date,
    minutes_between,
    parse_timestamp,
    percent,
    ratio,
    stable_avg,
    stable_sum,
    to_number,
)

TEXTS = {
    "2024-01-01T00:00:00": (datetime(2024, 1, 1), datetime(2024, 1, 1)),
    "2024-01-01 00:00:00": (datetime(2024, 1, 1), datetime(2024, 1, 1)),
    "2024-01-31T11:04:39.668033": (datetime(2024, 1, 31, 11, 4, 39), datetime(2024, 1, 31, 11, 4, 39)),
    "31/01/2024 23:55": (datetime(2024, 1, 31, 23, 55), datetime(2024, 1, 31, 23, 55)),
    # A prefix match stops at the minute, since the shorter layout is listed first.
    "31/01/2024 23:55:10": (datetime(2024, 1, 31, 23, 55), datetime(2024, 1, 31, 23, 55, 10)),
    "2024-01-31T11:04:39.668": (datetime(2024, 1, 31, 11, 4, 39), datetime(2024, 1, 31, 11, 4, 39)),
    "2024-01-31T11:04:39Z": (datetime(2024, 1, 31, 11, 4, 39), datetime(2024, 1, 31, 11, 4, 39)),
    "2024-01-31T11:04:39+02:00": (datetime(2024, 1, 31, 11, 4, 39), datetime(2024, 1, 31, 9, 4, 39)),
    "2024-01-31 11:04:39.5-0130": (datetime(2024, 1, 31, 11, 4, 39), datetime(2024, 1, 31, 12, 34, 39)),
    "2024-01-31T11:04:39.66803312345678901": (datetime(2024, 1, 31, 11, 4, 39), datetime(2024, 1, 31, 11, 4, 39)),
    "31/01/2024 23:55:10.25+02:00": (datetime(2024, 1, 31, 23, 55), datetime(2024, 1, 31, 21, 55, 10)),
    "2024-01-31T11:04:39\n": (datetime(2024, 1, 31, 11, 4, 39), None),
    "2024-01-31T11:04:3Z": (datetime(2024, 1, 31, 11, 4, 3), None),
    "2024-01-31T11:04:39garbage": (datetime(2024, 1, 31, 11, 4, 39), None),
    "31/01/2024 23:55Z": (datetime(2024, 1, 31, 23, 55), None),
    "2024-02-30T00:00:00": (None, None),
    "32/01/2024 23:55": (None, None),
    "2024-01-31T25:00:00": (None, None),
    "aa/bb/cccc dd:ee": (None, None),
    "2024-01-31": (None, None),
    "garbage": (None, None),
    "": (None, None),
    None: (None, None),
}


@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_timestamps_of_all_layouts(spark, prefix, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
        found = {r.text: r.ts for r in df.select("text", parse_timestamp("text", prefix=prefix).alias("ts")).collect()}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert found == {text: expected[0 if prefix else 1] for text, expected in TEXTS.items()}


def test_other_layouts_can_be_given(spark):
    df = spark.createDataFrame([("23h05 le 07.03.2024",), ("Mar 07 2024",)], "text string")
    layouts = ["HH'h'mm 'le' dd.MM.yyyy", "MMM dd yyyy"]
    found = [r[0] for r in df.select(parse_timestamp("text", layouts)).collect()]
    assert found == [datetime(2024, 3, 7, 23, 5), datetime(2024, 3, 7)]


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


def test_clamp_bounds_and_turns_null_into_low(spark):
    assert one(spark, clamp(F.lit(101.5), 0.0, 100.0)) == 100.0
    assert one(spark, clamp(F.lit(-3.0), 0.0, 100.0)) == 0.0
    assert one(spark, clamp(F.lit(55.5), 0.0, 100.0)) == 55.5
    assert one(spark, clamp(F.lit(None).cast("double"), 0.0, 100.0)) == 0.0


def test_division_by_zero_is_null(spark):
    assert one(spark, ratio(F.lit(0), F.lit(0))) is None
    assert one(spark, ratio(F.lit(3), F.lit(0))) is None
    assert one(spark, ratio(F.lit(1), F.lit(4))) == 0.25
    assert one(spark, percent(F.lit(604), F.lit(687))) == 604 / 687 * 100


def test_three_valued_or(spark):
    null = F.lit(None).cast("boolean")
    assert one(spark, any_true([null, F.lit(False)])) is None
    assert one(spark, any_true([null, F.lit(True)])) is True
    assert one(spark, any_true([F.lit(False), F.lit(False)])) is False


def test_durations_use_whole_seconds(spark):
    start = F.lit(datetime(2024, 1, 1, 0, 0, 0, 900000))
    end = F.lit(datetime(2024, 1, 1, 0, 1, 0, 100000))
    assert one(spark, minutes_between(start, end)) == 1.0
    assert one(spark, hours_between(end, start)) == -60 / 3600
    assert one(spark, hours_between(F.lit(None).cast("timestamp"), start)) is None


def test_numbers_from_text(spark):
    assert one(spark, to_number(F.lit(" 12.5"))) == 12.5
    assert one(spark, to_number(F.lit("12,5"))) is None
    assert one(spark, to_number(F.lit("n/a"))) is None


def test_day_labels(spark):
    assert str(one(spark, label_date(F.lit("2024-01-05")))) == "2024-01-05"


def test_stable_totals_do_not_depend_on_partitioning(spark):
    df = spark.range(2000).select(((F.col("id") * 7919) % 1000 / 100.0 + 0.01).alias("v"))
    results = {
        df.repartition(n).agg(stable_sum("v", 6).alias("s"), stable_avg("v", 6).alias("a")).first() for n in (1, 3, 7)
    }
    assert len(results) == 1
    plain = df.agg(stable_sum("v", None).alias("s"), stable_avg("v", None).alias("a")).first()
    exact = results.pop()
    assert plain.s == pytest.approx(exact.s) and plain.a == pytest.approx(exact.a)


def test_layouts_of_one_shape_are_tried_in_turn(spark):
    df = spark.createDataFrame([("25/03/2024 10:00",), ("03/25/2024 10:00",), ("03/04/2024 10:00",)], "text string")
    found = df.select(parse_timestamp("text", ["dd/MM/yyyy HH:mm", "MM/dd/yyyy HH:mm"])).collect()
    assert [r[0] for r in found] == [datetime(2024, 3, 25, 10), datetime(2024, 3, 25, 10), datetime(2024, 4, 3, 10)]


def test_a_text_is_matched_and_cast_but_never_searched(spark):
    df = spark.createDataFrame([("2024-01-31T11:04:39",)], "text string").select(parse_timestamp("text").alias("ts"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == plan.count("regexp_replace") == 0
    assert plan.count("RLIKE") <= 4 and plan.count("cast(") <= 1


def test_whole_units_are_summed_as_longs_like_decimals(spark):
    values = [0.1, 0.2, -0.3, 1e-7, 5e-7, 1.5e-6, -2.5e-6, 2.0000005, 123456.789, 84197.04, -0.0, 0.0, 2.0**29 + 0.1, 2.0**30, 3e9 + 0.5]
    values += [1.1e15, -7.3e18, 1 / 3, 2 / 3, 1e-300, 0.0020, 99999999.999999, 536870911.123457, -1073741823.999999, None]
    values += [i / 1e6 * 997 for i in range(-300, 300)] + [i * 0.1 + i * 1e-7 for i in range(300)]
    df = spark.createDataFrame([(i, i % 40, 0, v) for i, v in enumerate(values)], "i int, g int, one int, v double")
    for scale in (1, 2, 4, 6):
        plain = F.sum(F.col("v").cast(f"decimal(28,{scale})")).cast("double").alias("d")
        for by in ("i", "g", "one"):
            summed = df.groupBy(by).agg(stable_sum("v", scale).alias("s"), plain)
            assert summed.where("NOT (s <=> d)").collect() == [] and summed.count() > 0
    assert "shiftright" in df.agg(stable_sum("v", 6))._jdf.queryExecution().analyzed().toString()
