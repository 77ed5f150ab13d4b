from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from plantmetrics import schemas
from plantmetrics.config import DEFAULTS, SizeLimits
from plantmetrics.functions.numeric import stable_sum
from plantmetrics.plans import dashboards, gold, silver
from plantmetrics.sources import read_days, write_bucketed, write_days

SENSOR_COLUMNS = "timestamp string, machine_id string, temperature_c double, vibration_mms double, pression_bar double, courant_a double, _row_id long"


def readings(spark, rows):
    return spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], SENSOR_COLUMNS)


def test_silver_sensors_fills_then_labels(spark):
    rows = [
        ("2024-01-01T00:00:00", "M1", None, 1.0, 4.0, 5.0),
        ("01/01/2024 00:05", "M1", 125.0, 1.0, 4.0, 5.0),
        ("2024-01-01T00:10:00", "M1", None, 1.0, 4.0, 5.0),
        ("2024-01-01T00:10:00", "M1", 70.0, -1.0, 4.0, 5.0),
        ("2024-01-01T00:15:00", "M1", None, -1.0, 4.0, 5.0),
    ]
    clean = silver.silver_sensors(readings(spark, rows)).orderBy("timestamp_clean").collect()
    assert [r._row_id for r in clean] == [0, 1, 2, 4]
    # A missing first value has nothing to be filled from; an invalid one is carried forward like any other.
    assert [r.temperature_filled for r in clean] == [None, 125.0, 125.0, 125.0]
    assert [r.any_was_null for r in clean] == [False, False, True, True]
    assert [r.anomalie_detectee for r in clean] == [None, True, None, True]
    assert [r.qualite_donnee for r in clean] == ["VALID", "INVALID", "INTERPOLATED", "INVALID"]


def test_invalid_readings_can_be_kept_out_of_the_fill(spark):
    rows = [
        ("2024-01-01T00:00:00", "M1", 60.0, 1.0, 4.0, 5.0),
        ("2024-01-01T00:05:00", "M1", 125.0, -1.0, 4.0, 5.0),
        ("2024-01-01T00:10:00", "M1", None, None, 4.0, 5.0),
    ]
    settings = replace(DEFAULTS, exclude_invalid_from_fill=True)
    clean = silver.silver_sensors(readings(spark, rows), settings).orderBy("timestamp_clean").collect()
    assert [r.temperature_filled for r in clean] == [60.0, 60.0, 60.0]
    assert [r.vibration_filled for r in clean] == [1.0, 1.0, 1.0]


def test_dedup_on_text_or_on_time(spark):
    rows = [("2024-01-01T00:05:00", "M1", 1.0, 1.0, 1.0, 1.0), ("01/01/2024 00:05", "M1", 2.0, 1.0, 1.0, 1.0)]
    df = readings(spark, rows)
    assert silver.silver_sensors(df).count() == 2
    assert silver.silver_sensors(df, replace(DEFAULTS, dedup_on="parsed")).count() == 1
    with pytest.raises(ValueError):
        silver.silver_sensors(df, replace(DEFAULTS, dedup_on="no"))


def test_silver_plans_agree_with_a_hot_machine(spark, same_rows):
    i = F.col("id")
    df = spark.range(900, numPartitions=4).select(
        F.when(i % 3 == 0, F.date_format(F.timestamp_seconds(i * 60), "dd/MM/yyyy HH:mm"))
        .when(i % 50 == 1, "unreadable")
        .otherwise(F.date_format(F.timestamp_seconds(F.pmod(i * 7919, F.lit(5000))), "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("timestamp"),
        F.when(i % 2 == 0, "hot").otherwise(F.concat(F.lit("m"), i % 7)).alias("machine_id"),
        *[F.when(i % k != 0, i.cast("double")).alias(c) for k, c in ((3, "temperature_c"), (4, "vibration_mms"))],
        *[F.when(i % k != 0, i.cast("double")).alias(c) for k, c in ((5, "pression_bar"), (7, "courant_a"))],
        i.alias("_row_id"),
    )
    settings = replace(DEFAULTS, limits=SizeLimits(max_group_rows=100, chunk_rows=60))
    same_rows(silver.silver_sensors(df, settings, "window"), silver.silver_sensors(df, settings, "auto"))
    states = df.select("timestamp", "machine_id", F.lit("ARRET").alias("etat"), F.lit("x").alias("code_alarme"), "_row_id")
    same_rows(silver.silver_scada(states, settings, "window"), silver.silver_scada(states, settings, "auto"))


def test_one_exchange_when_no_machine_is_hot(spark):
    df = readings(spark, [("2024-01-01T00:00:00", "M1", 60.0, 1.0, 4.0, 5.0)])
    plan = silver.silver_sensors(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_partitions_follow_the_counted_rows(spark):
    df = readings(spark, [("2024-01-01T00:00:00", f"M{i}", 60.0, 1.0, 4.0, 5.0) for i in range(40)])
    few = silver.silver_sensors(df, replace(DEFAULTS, limits=SizeLimits(chunk_rows=2)))
    assert "hashpartitioning(machine_id" in few._jdf.queryExecution().executedPlan().toString()
    assert ", 20), REPARTITION_BY_NUM" in few._jdf.queryExecution().executedPlan().toString()


STATE_COLUMNS = "event_id string, timestamp string, machine_id string, etat string, code_alarme string, _row_id long"


def test_state_durations(spark):
    rows = [
        ("E1", "2024-01-01T00:00:00", "M1", "ARRET", None, 0),
        ("E2", "2024-01-01T00:30:30", "M1", "ALARME", "alm_7", 1),
        ("E3", "2024-01-01T00:30:30", "M1", "EN_MARCHE", None, 2),
        ("E3", "2024-01-01T00:30:30", "M1", "EN_MARCHE", None, 3),
        ("E4", "2024-01-01T00:00:00", "M2", "ARRET", None, 4),
    ]
    states = {r.event_id: r for r in silver.silver_scada(spark.createDataFrame(rows, STATE_COLUMNS)).collect()}
    assert [states[e].duree_etat_minutes for e in ("E1", "E2", "E3", "E4")] == [30.5, 0.0, None, None]
    assert states["E2"].code_alarme == "ALM_7"
    assert states["E1"].next_timestamp == datetime(2024, 1, 1, 0, 30, 30)


def test_silver_mes(spark):
    rows = [
        ("O1", "P", "M1", "2024-01-30T12:15:35", "2024-01-31T11:04:39.668033", "2024-01-31T16:46:37.561183", 687, 604, 2.37),
        ("O2", "P", "M1", "2024-01-16T10:14:39", "2024-01-17T06:08:19.842372", None, 0, 5, 2.0),
        ("O3", "P", "M1", "2024-01-16T10:14:39", "2024-01-17T06:08:19.842372", "2024-01-17T06:08:19.9", 10, 5, 2.0),
    ]
    late, running, on_time = silver.silver_mes(spark.createDataFrame(rows, schemas.MES)).orderBy("ordre_id").collect()
    assert late.retard_heures == (5 * 3600 + 41 * 60 + 58) / 3600 and late.ordre_statut == "EN_RETARD"
    assert late.date_fin_prevue_clean == datetime(2024, 1, 31, 11, 4, 39)
    assert late.taux_rendement_pct == 604 / 687 * 100
    assert (running.ordre_statut, running.retard_heures, running.taux_rendement_pct) == ("EN_COURS", None, None)
    assert (on_time.ordre_statut, on_time.retard_heures) == ("A_TEMPS", 0.0)


def sensors_and_states(spark):
    sensors = spark.createDataFrame(
        [
            (datetime(2024, 1, 1), "M1", 60.0, 2.0, 4.0, None),
            (datetime(2024, 1, 1, 1), "M1", None, 4.0, 5.0, True),
            (datetime(2024, 1, 2), "M2", 50.0, 2.0, 4.0, False),
            (None, "M1", 1.0, 1.0, 1.0, False),
        ],
        "timestamp_clean timestamp, machine_id string, temperature_c double, vibration_mms double, pression_bar double, anomalie_detectee boolean",
    )
    states = spark.createDataFrame(
        [
            (datetime(2024, 1, 1), "M1", "ARRET", 20000.0),
            (datetime(2024, 1, 1, 2), "M1", "ALARME", 5.0),
            (datetime(2024, 1, 1, 3), "M1", "ARRET", None),
            (None, "M1", "ALARME", 5.0),
            (datetime(2024, 1, 9), "M3", "ARRET", 1.0),
        ],
        "timestamp_clean timestamp, machine_id string, etat string, duree_etat_minutes double",
    )
    return sensors, states


def test_daily_kpis(spark):
    rows = {(r.date, r.machine_id): r for r in gold.gold_kpis_machines(*sensors_and_states(spark)).collect()}
    day = rows[date(2024, 1, 1), "M1"]
    assert (day.temp_moyenne, day.temp_max, day.vibration_moyenne, day.nb_mesures) == (60.0, 60.0, 3.0, 2)
    assert (day.nb_anomalies_capteurs, day.nb_alarmes, day.duree_arret_minutes) == (1, 1, 20000.0)
    assert day.taux_disponibilite_pct == 0.0
    alone = rows[date(2024, 1, 2), "M2"]
    assert (alone.nb_alarmes, alone.duree_arret_minutes, alone.taux_disponibilite_pct) == (0, 0.0, 100.0)
    undated = rows[None, "M1"]
    assert (undated.nb_mesures, undated.nb_alarmes) == (1, 0)
    assert len(rows) == 3


def test_weekly_oee_edges(spark):
    sensors, states = sensors_and_states(spark)
    mes = spark.createDataFrame(
        [(datetime(2024, 1, 3), "M2", 4000, 5000, 2.0), (datetime(2024, 1, 3), "M1", 10, 10, 0.0)],
        "date_debut_clean timestamp, machine_id string, quantite_produite int, quantite_prevue int, taux_rebut_pct double",
    )
    rows = {(r.semaine, r.machine_id): r for r in gold.gold_oee(sensors, states, mes).collect()}
    stopped = rows[1, "M1"]
    assert (stopped.disponibilite, stopped.performance, stopped.oee_pct) == (0.0, 0.0, 0.0)
    assert stopped.temps_disponible_heures == (10080 - 20000) / 60
    busy = rows[1, "M2"]
    assert (busy.disponibilite, busy.performance, busy.qualite_oee) == (100.0, round(4000 / 84000 * 100, 2), 98.0)
    assert busy.oee_pct == round(4000 / 84000 * 0.98 * 100, 2)
    idle = rows[None, "M1"]
    assert (idle.sum_produite, idle.sum_prevue, idle.qualite_oee, idle.oee_pct) == (0, 1, 0.0, 0.0)


def test_weeks_add_up_to_days(spark):
    sensors, states = sensors_and_states(spark)
    days = gold.daily_states(states).groupBy(F.weekofyear("date").alias("semaine"), "machine_id")
    daily = days.agg(F.sum("duree_arret_minutes").alias("sum_arret_minutes"))
    assert gold.weekly_downtime(states).exceptAll(daily).count() == 0


def test_maintenance_without_failures(spark):
    rows = [("M1", "PREVENTIVE", 2.0, 100.0), ("M2", "CORRECTIVE", 3.0, 50.005), ("M2", "CORRECTIVE", 4.5, 50.0)]
    df = spark.createDataFrame(rows, "machine_id string, type_intervention string, duree_heures double, cout_eur double")
    costs = gold.gold_maintenance_cost(df)
    found = {r.machine_id: tuple(r)[1:] for r in costs.collect()}
    assert found["M1"] == (1, 0, 100.0, 2.0, None, None)
    assert found["M2"] == (0, 2, 100.01, 7.5, 3.75, 360.0)
    assert [tuple(r) for r in dashboards.mtbf_ranking(costs).collect()] == [("M2", 360.0, "OK")]
    split = dashboards.cost_split(costs).first()
    assert (split.cout_total, split.cout_preventif) == (pytest.approx(200.01), 100.0)


def test_anomaly_points_from_text_measures(spark):
    rows = [(0, "M1", "99.5", "1.0"), (1, "M1", "broken", "1.0"), (2, "M1", "130", "-2"), (3, "M1", "20", "")]
    df = spark.createDataFrame(rows, "id long, machine_id string, temperature_c string, vibration_mms string")
    points = dashboards.anomaly_points(df, "id", DEFAULTS.range_rules[:2])
    assert sorted((r.id, r.anomalie_detectee, r.surchauffe) for r in points.collect()) == [(0, False, True), (2, True, True)]


def test_alarm_table_per_machine(spark):
    kpis = gold.gold_kpis_machines(*sensors_and_states(spark))
    wide = dashboards.alarm_table(kpis, labels=["M1", "M2"])
    assert sorted(map(tuple, wide.collect())) == [("2024-01-01", 1, 0, 0), ("2024-01-02", 0, 0, 0)]
    unlisted = dashboards.alarm_table(kpis, labels=["M2"]).filter("jour = '2024-01-01'").first()
    assert (unlisted.M2, unlisted.autres) == (0, 1)
    long = {(r.jour, r.machine_id): r.nb_alarmes for r in dashboards.alarm_table(kpis).collect()}
    assert long["2024-01-01", "M1"] == 1 and sum(long.values()) == 1


def test_only_needed_columns_and_rows_are_scanned(spark, tmp_path):
    rows = [("2024-01-01T00:00:00", "M1", 60.0, 1.0, 4.0, 5.0)]
    silver.silver_sensors(readings(spark, rows)).write.parquet(str(tmp_path / "s"))
    sensors = spark.read.parquet(str(tmp_path / "s"))
    weekly = gold.weekly_sensors(sensors)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<machine_id:string,timestamp_clean:timestamp>" in weekly
    plotted = dashboards.temperature_histogram(sensors)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(temperature_c,-10.0)" in plotted
    assert "ReadSchema: struct<machine_id:string,temperature_c:double>" in plotted


def test_charts_are_in_plotting_order(spark):
    rows = [(3, "M2", 90.0), (1, "M2", 80.0), (2, "M1", None), (1, "M1", 85.0), (2, "M2", 84.9)]
    weeks = spark.createDataFrame(rows, "semaine int, machine_id string, oee_pct double").repartition(3)
    found = [tuple(r) for r in dashboards.oee_targets(weeks).collect()]
    assert found == [
        ("M1", 1, 85.0, "OK"),
        ("M1", 2, None, None),
        ("M2", 1, 80.0, "KO"),
        ("M2", 2, 84.9, "KO"),
        ("M2", 3, 90.0, "OK"),
    ]


def test_least_reliable_machine_comes_first(spark):
    rows = [("M1", 240.0), ("M2", 80.0), ("M3", None), ("M4", 200.0), ("M0", 80.0)]
    costs = spark.createDataFrame(rows, "machine_id string, mtbf_heures double").repartition(3)
    found = [tuple(r) for r in dashboards.mtbf_ranking(costs).collect()]
    assert found == [("M0", 80.0, "KO"), ("M2", 80.0, "KO"), ("M4", 200.0, "OK"), ("M1", 240.0, "OK")]


def test_large_costs_have_a_total(spark):
    rows = [("M1", 5e12), ("M2", 0.25)]
    total = spark.createDataFrame(rows, "machine_id string, cout double").agg(stable_sum("cout", 6)).first()[0]
    assert total == 5e12 + 0.25


def test_gold_reads_the_files_of_its_days_only(spark, tmp_path):
    sensors, states = sensors_and_states(spark)
    paths = [str(tmp_path / name) for name in ("sensors", "states")]
    for path, frame in zip(paths, (sensors, states)):
        write_days(frame, path, "timestamp_clean")
    days = [read_days(spark, path, date(2024, 1, 1), date(2024, 1, 1)) for path in paths]
    kpis = gold.gold_kpis_machines(*days)
    plan = kpis._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(jour") == 2
    assert [(r.machine_id, r.nb_mesures) for r in kpis.collect()] == [("M1", 2)]


def test_gold_over_buckets_moves_no_reading(spark, tmp_path, same_rows):
    sensors, states = sensors_and_states(spark)
    for name, frame in (("b_sensors", sensors), ("b_states", states)):
        assert write_bucketed(frame, name, str(tmp_path / name), "machine_id", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        kpis = gold.gold_kpis_machines(spark.table("b_sensors"), spark.table("b_states"))
        assert "Exchange" not in kpis._jdf.queryExecution().executedPlan().toString()
        same_rows(gold.gold_kpis_machines(sensors, states), kpis)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE b_sensors")
        spark.sql("DROP TABLE b_states")
