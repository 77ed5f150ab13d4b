"""Silver to gold: KPI tables per machine, week, product and month.

All of them aggregate before they shuffle, so a machine with most of the rows sends one partial
row per task and key. The joins that follow see one row per key on each side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.config import DAILY_DEFAULTS, WEEKLY_DEFAULTS, KpiSettings
from plantmetrics.functions.numeric import clamp, count_if, percent, ratio, stable_avg, stable_sum
from plantmetrics.operators.cleaning import fill_defaults

MACHINE = "machine_id"
DEFAULT_KPI = KpiSettings()


def _downtime(kpi: KpiSettings) -> Column:
    """Minutes stopped, booked to the period in which the stop begins. A last, open stop counts nothing."""
    stopped = F.when(F.col("etat") == "ARRET", F.col("duree_etat_minutes")).otherwise(F.lit(0.0))
    return stable_sum(stopped, kpi.sum_scale)


def daily_sensors(sensors: DataFrame, kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    """Per day and machine, over the readings as measured (not the filled ones)."""
    return sensors.groupBy(F.to_date("timestamp_clean").alias("date"), MACHINE).agg(
        stable_avg("temperature_c", kpi.sum_scale).alias("temp_moyenne"),
        F.max("temperature_c").alias("temp_max"),
        stable_avg("vibration_mms", kpi.sum_scale).alias("vibration_moyenne"),
        stable_avg("pression_bar", kpi.sum_scale).alias("pression_moyenne"),
        count_if(F.col("anomalie_detectee")).alias("nb_anomalies_capteurs"),
        F.count(F.lit(1)).alias("nb_mesures"),
    )


def daily_states(scada: DataFrame, kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    return scada.groupBy(F.to_date("timestamp_clean").alias("date"), MACHINE).agg(
        count_if(F.col("etat") == "ALARME").alias("nb_alarmes"),
        _downtime(kpi).alias("duree_arret_minutes"),
    )


def join_daily(sensors_day: DataFrame, states_day: DataFrame) -> DataFrame:
    """Days with readings, each with its states if there are any. Readings without a date match nothing."""
    return sensors_day.join(states_day, ["date", MACHINE], "left")


def gold_kpis_machines(sensors: DataFrame, scada: DataFrame, kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    days = join_daily(daily_sensors(sensors, kpi), daily_states(scada, kpi))
    return add_availability(fill_defaults(days, DAILY_DEFAULTS), kpi)


def add_availability(days: DataFrame, kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    """Share of the day not stopped, in percent; a stop outlasting the day counts as all of it."""
    day = F.lit(kpi.minutes_per_day)
    availability = (day - F.col("duree_arret_minutes")) / day * F.lit(100.0)
    return days.withColumn("taux_disponibilite_pct", clamp(availability, 0.0, 100.0))


def _week(timestamp: str) -> Column:
    """ISO week number, without the year."""
    return F.weekofyear(timestamp).alias("semaine")


def weekly_sensors(sensors: DataFrame) -> DataFrame:
    return sensors.groupBy(_week("timestamp_clean"), MACHINE).agg(F.count(F.lit(1)).alias("nb_mesures_semaine"))


def weekly_downtime(scada: DataFrame, kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    return scada.groupBy(_week("timestamp_clean"), MACHINE).agg(_downtime(kpi).alias("sum_arret_minutes"))


def weekly_production(mes: DataFrame, kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    scrapped = F.col("quantite_produite") * F.col("taux_rebut_pct") / F.lit(100.0)
    return mes.groupBy(_week("date_debut_clean"), MACHINE).agg(
        F.sum("quantite_produite").alias("sum_produite"),
        F.sum("quantite_prevue").alias("sum_prevue"),
        stable_sum(scrapped, kpi.sum_scale).alias("sum_rebuts"),
    )


def join_weekly(sensors_week: DataFrame, downtime_week: DataFrame, production_week: DataFrame) -> DataFrame:
    """Weeks with readings, each with its downtime and production if there are any."""
    keys = ["semaine", MACHINE]
    return sensors_week.join(downtime_week, keys, "left").join(production_week, keys, "left")


def oee_columns(weeks: DataFrame, kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    """Availability, performance, quality and OEE in percent, from weekly totals without NULLs.

    Available hours may be negative when a stop begun that week outlasts it; the rates may not.
    """
    week = F.lit(kpi.minutes_per_week)
    left_minutes = week - F.col("sum_arret_minutes")
    capacity = F.lit(kpi.units_per_hour) * F.col("temps_disponible_heures")
    good = F.col("sum_produite") - F.col("sum_rebuts")
    rates = ["disponibilite", "performance", "qualite_oee"]
    measured = weeks.withColumns(
        {"disponibilite": clamp(left_minutes / week, 0.0, 1.0), "temps_disponible_heures": left_minutes / F.lit(60.0)}
    ).withColumns(
        {
            "performance": clamp(ratio("sum_produite", capacity), 0.0, 1.0),
            "qualite_oee": clamp(ratio(good, "sum_produite"), 0.0, 1.0),
        }
    )
    oee = F.col(rates[0]) * F.col(rates[1]) * F.col(rates[2]) * F.lit(100.0)
    rated = measured.withColumn("oee_pct", F.round(clamp(oee, 0.0, 100.0), 2))
    return rated.withColumns({rate: F.round(F.col(rate) * 100, 2) for rate in rates})


def gold_oee(sensors: DataFrame, scada: DataFrame, mes: DataFrame, kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    """Weekly Overall Equipment Effectiveness per machine."""
    weeks = join_weekly(weekly_sensors(sensors), weekly_downtime(scada, kpi), weekly_production(mes, kpi))
    return oee_columns(fill_defaults(weeks, WEEKLY_DEFAULTS), kpi)


def gold_maintenance_cost(maintenance: DataFrame, kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    """Interventions, cost, mean time to repair and mean time between failures per machine."""
    corrective = F.col("type_intervention") == "CORRECTIVE"
    totals = maintenance.groupBy(MACHINE).agg(
        count_if(F.col("type_intervention") == "PREVENTIVE").alias("nb_interventions_preventives"),
        count_if(corrective).alias("nb_interventions_correctives"),
        F.round(stable_sum("cout_eur", kpi.sum_scale), 2).alias("cout_total_eur"),
        stable_sum("duree_heures", kpi.sum_scale).alias("duree_totale_heures"),
        F.round(stable_avg(F.when(corrective, F.col("duree_heures")), kpi.sum_scale), 2).alias("mttr_heures"),
    )
    mtbf = ratio(F.lit(kpi.mtbf_horizon_hours), "nb_interventions_correctives")
    return totals.withColumn("mtbf_heures", F.round(mtbf, 2))


def gold_production_summary(mes: DataFrame, kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    """Per calendar month (of any year) and product."""
    totals = mes.groupBy(F.month("date_debut_clean").alias("mois"), "produit_id").agg(
        F.sum("quantite_produite").alias("quantite_totale_produite"),
        F.sum("quantite_prevue").alias("quantite_totale_prevue"),
        F.round(stable_avg("taux_rebut_pct", kpi.sum_scale), 2).alias("taux_rebut_moyen_pct"),
        count_if(F.col("ordre_statut") == "EN_RETARD").alias("nb_ordres_en_retard"),
    )
    achieved = percent("quantite_totale_produite", "quantite_totale_prevue")
    return totals.withColumn("taux_realisation_pct", F.round(achieved, 2))
