import pytest
from pyspark.sql import functions as F

from plantmetrics.config import RANGE_RULES
from plantmetrics.operators import cleaning


def test_keep_first_takes_the_lowest_row_id(spark):
    rows = [("M1", "t", 9, 125.0), ("M1", "t", 0, 60.0), ("M1", "u", 3, 61.0), (None, "t", 5, 1.0), (None, "t", 4, 2.0)]
    df = spark.createDataFrame(rows, "m string, t string, _row_id long, v double")
    kept = cleaning.keep_first(df, ["m", "t"], ["_row_id"])
    assert kept.columns == df.columns
    assert sorted((r._row_id, r.v) for r in kept.collect()) == [(0, 60.0), (3, 61.0), (4, 2.0)]


def test_keep_first_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id")
    plan = cleaning.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Partial")  # children are printed below their parents


FLAG_CASES = [
    ((None, 1.0, 4.0), (None, False, False, None)),
    ((None, -1.0, 4.0), (None, True, False, True)),
    ((60.0, 1.0, 4.0), (False, False, False, False)),
    ((-10.0, 0.0, 0.0), (False, False, False, False)),
    ((120.0, 1.0, 4.0), (False, False, False, False)),
    ((120.01, 1.0, None), (True, False, None, True)),
    ((-10.01, 1.0, 4.0), (True, False, False, True)),
    ((60.0, 1.0, -0.1), (False, False, True, True)),
]


@pytest.mark.parametrize("values,expected", FLAG_CASES)
def test_anomaly_flags(spark, values, expected):
    df = spark.createDataFrame([values], "temperature_c double, vibration_mms double, pression_bar double")
    row = cleaning.flag_anomalies(df, RANGE_RULES).first()
    names = [rule.flag for rule in RANGE_RULES]
    assert tuple(row[n] for n in [*names, "anomalie_detectee"]) == expected
    known = df.select(cleaning.anomaly_known(RANGE_RULES[:2])).first()[0]
    assert known is (expected[0] is True or expected[1] is True)


def test_quality_label_order(spark):
    cases = [
        (True, True, "INVALID"),
        (None, True, "INTERPOLATED"),
        (False, True, "INTERPOLATED"),
        (None, False, "VALID"),
        (False, False, "VALID"),
    ]
    df = spark.createDataFrame(cases, "a boolean, n boolean, expected string")
    assert df.filter(cleaning.quality_label("a", "n") != F.col("expected")).count() == 0


def test_order_status(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (NULL, NULL, 'EN_COURS'), (TIMESTAMP'2024-01-01', 0D, 'A_TEMPS'), "
        "(TIMESTAMP'2024-01-01', -1D, 'A_TEMPS'), (TIMESTAMP'2024-01-01', 0.1D, 'EN_RETARD') AS t(f, d, expected)"
    )
    assert df.filter(cleaning.order_status("f", "d") != F.col("expected")).count() == 0


def test_threshold_status(spark):
    df = spark.createDataFrame([(200.0,), (199.9,), (None,)], "v double")
    assert [r[0] for r in df.select(cleaning.threshold_status("v", 200.0)).collect()] == ["OK", "KO", None]


def test_lineage_columns(spark):
    df = cleaning.add_lineage(spark.range(100).repartition(3), "f.csv", "IOT")
    row = df.agg(
        F.countDistinct("_row_id").alias("ids"),
        F.countDistinct("_ingestion_timestamp").alias("times"),
        F.min("_source_file").alias("f"),
        F.max("_source_system").alias("s"),
    ).first()
    assert (row.ids, row.times, row.f, row.s) == (100, 1, "f.csv", "IOT")


def test_fill_defaults_per_column(spark):
    df = spark.createDataFrame([(None, None), (2, 3.0)], "a long, b double")
    assert [tuple(r) for r in cleaning.fill_defaults(df, {"a": 1, "b": 0.0}).collect()] == [(1, 0.0), (2, 3.0)]
