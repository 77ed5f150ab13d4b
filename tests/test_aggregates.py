from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantmetrics.config import SizeLimits
from plantmetrics.operators import aggregates


def test_pivot_fixed_and_discovered_labels(spark):
    df = spark.createDataFrame([("d1", "a", 1), ("d1", "a", 2), ("d2", "b", 5), ("d2", None, 7)], "d string, c string, n long")
    fixed = aggregates.pivot_table(df, "d", "c", F.sum("n"), ["a", "b", "z"], fill=0)
    assert sorted(map(tuple, fixed.collect())) == [("d1", 3, 0, 0), ("d2", 0, 5, 0)]
    rest = aggregates.pivot_table(df, "d", "c", F.sum("n"), ["a"], fill=0, other="autres")
    assert rest.columns == ["d", "a", "autres"]
    assert rest.agg(F.sum(F.col("a") + F.col("autres"))).first() == df.agg(F.sum("n")).first()


def test_arg_max_takes_the_first_peak_and_skips_null(spark):
    days = [date(2024, 1, d) for d in (1, 2, 3, 4)]
    rows = [("a", days[3], 9.0), ("a", days[1], 9.0), ("a", days[0], 3.0), ("a", days[2], None), ("b", days[0], None)]
    df = spark.createDataFrame(rows, "m string, day date, v double")
    found = {r.m: (r.day, r.v) for r in aggregates.arg_max(df, "m", "v", "day").collect()}
    assert found == {"a": (days[1], 9.0), "b": (None, None)}


@pytest.mark.parametrize("strategy", ["window", "chunked"])
def test_quantiles_match_numpy(spark, strategy):
    rng = np.random.default_rng(3)
    groups = {"hot": np.r_[rng.normal(0, 1, 700), np.full(900, 0.25)], "one": np.array([4.0]), "few": rng.normal(5, 2, 8)}
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("hot", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probabilities = {"lowest": 0.0, "q1": 0.25, "median": 0.5, "p99": 0.99, "highest": 1.0}
    found = aggregates.quantiles(df, "g", "v", probabilities, strategy, SizeLimits(chunk_rows=50))
    rows = {r.g: r for r in found.collect()}
    assert set(rows) == set(groups)
    for name, values in groups.items():
        assert rows[name].n_values == len(values)
        expected = np.quantile(values, list(probabilities.values()))
        assert [rows[name][p] for p in probabilities] == pytest.approx(expected.tolist())


def test_histogram(spark):
    df = spark.createDataFrame([("a", 4.9), ("a", 5.0), ("a", -0.1), ("a", None)], "g string, v double")
    assert sorted(map(tuple, aggregates.histogram(df, "g", "v", 5.0).collect())) == [("a", -1, 1), ("a", 0, 1), ("a", 1, 1)]


def test_sample_is_repeatable_and_bounded(spark):
    df = spark.range(1000)
    first = {r.id for r in aggregates.sample_rows(df, "id", 50, 42).collect()}
    again = {r.id for r in aggregates.sample_rows(df.repartition(7), "id", 50, 42).collect()}
    other = {r.id for r in aggregates.sample_rows(df, "id", 50, 43).collect()}
    assert first == again and len(first) == 50 and other != first
    assert aggregates.sample_rows(spark.range(5), "id", 50, 42).count() == 5


def test_side_by_side(spark):
    parts = [spark.range(1).selectExpr("1 AS a"), spark.range(1).selectExpr("'x' AS b", "CAST(NULL AS INT) AS c")]
    assert tuple(aggregates.side_by_side(*parts).first()) == (1, "x", None)


def test_counts_and_means(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", 3.0)], "g string, v double")
    assert [tuple(r) for r in aggregates.category_counts(df, "g").collect()] == [("a", 1), ("b", 2)]
    assert sorted(map(tuple, aggregates.group_means(df, "g", ["v"]).collect())) == [("a", 2.0), ("b", 2.0)]


def test_selected_quantiles_equal_sorted_ones(spark, same_rows):
    i = F.col("id")
    crowded = F.when(i % 3 == 0, 5.0).when(i % 101 == 1, float("inf")).when(i % 103 == 1, float("nan")).when(i % 107 == 1, -1e300)
    df = spark.range(3000, numPartitions=4).select(
        F.when(i % 2 == 0, "hot").when(i % 31 == 0, None).otherwise(F.concat(F.lit("m"), i % 200)).alias("m"),
        F.when(i % 9 != 1, crowded.otherwise(F.exp((i % 500).cast("double") / 20))).alias("v"),
    )
    wanted = {"low": 0.0, "q1": 0.25, "median": 0.5, "top": 1.0}

    def found(strategy, limits=SizeLimits()):
        frame = aggregates.quantiles(df, "m", "v", wanted, strategy, limits)
        # infinite neighbours give NaN in both plans
        return frame.select("m", "n_values", *(F.col(c).cast("string").alias(c) for c in wanted))

    same_rows(found("window"), found("selected"))
    same_rows(found("window"), found("selected", SizeLimits(broadcast_rows=0)))
    same_rows(found("window"), found("auto", SizeLimits(max_group_rows=10)))
    plan = aggregates.quantiles(df, "m", "v", wanted, "selected")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan
    assert aggregates.quantiles(df.limit(0), "m", "v", wanted, "selected").count() == 0
