"""Data behind the dashboards and the closing summary, as Spark frames small enough to plot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.config import DEFAULTS, KpiSettings, RangeRule, Settings, SizeLimits
from plantmetrics.functions.numeric import count_if, ratio, stable_avg, stable_sum, to_number
from plantmetrics.functions.timestamps import date_label
from plantmetrics.operators.aggregates import (
    arg_max,
    group_means,
    histogram,
    pivot_table,
    quantiles,
    sample_rows,
    side_by_side,
)
from plantmetrics.operators.cleaning import anomaly_known, threshold_status

MACHINE = "machine_id"
DEFAULT_KPI = KpiSettings()
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def series(df: DataFrame, over: str, columns: Sequence[str]) -> DataFrame:
    """One line per machine, in plotting order."""
    return df.select(MACHINE, over, *columns).orderBy(MACHINE, over)


def hottest_day(kpis: DataFrame) -> DataFrame:
    """The day of each machine's highest temperature, the first one on a tie."""
    return arg_max(kpis, MACHINE, "temp_max", "date")


def alarm_table(
    daily: DataFrame, columns: str = MACHINE, labels: Sequence | None = None, value: str = "nb_alarmes"
) -> DataFrame:
    """Alarms per day and machine: a row each, or with ``labels`` a row per day and a column per label.

    The long form holds any number of machines. In the wide one 0 stands where there were none, and alarms of
    labels that aren't listed are summed in ``autres``.
    """
    dated = daily.dropna(subset=["date"]).withColumn("jour", date_label("date"))
    if labels is None:
        return dated.groupBy("jour", columns).agg(F.sum(value).alias(value))
    return pivot_table(dated, "jour", columns, F.sum(value), labels, fill=0, other="autres")


def oee_heatmap(oee: DataFrame, weeks: Sequence[int] = tuple(range(1, 54)), kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    """Mean OEE per machine (row) and ISO week (column); an empty cell stays NULL."""
    return pivot_table(oee, MACHINE, "semaine", stable_avg("oee_pct", kpi.sum_scale), weeks)


def oee_components(oee: DataFrame, kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    return group_means(oee, MACHINE, ["disponibilite", "performance", "qualite_oee"], kpi.sum_scale)


def oee_targets(oee: DataFrame, kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    """Weekly OEE in plotting order, with whether it reaches the target."""
    return series(oee, "semaine", ["oee_pct"]).withColumn(
        "objectif_oee", threshold_status("oee_pct", kpi.oee_target_pct)
    )


def anomaly_points(
    sensors: DataFrame, row_id: str, rules: Sequence[RangeRule], kpi: KpiSettings = DEFAULT_KPI
) -> DataFrame:
    """A bounded, repeatable sample of readings for the temperature/vibration scatter plot.

    Measures may still be text; what is not a number is left out, as are incomplete readings. The
    chart ignores the pressure rule: pass the rules of the two plotted measures.
    """
    axes = ["temperature_c", "vibration_mms"]
    numbers = sensors.withColumns({name: to_number(name) for name in axes}).dropna(subset=axes)
    points = numbers.select(
        row_id,
        MACHINE,
        *axes,
        anomaly_known(rules).alias("anomalie_detectee"),
        (F.col("temperature_c") > kpi.overheat_c).alias("surchauffe"),
    )
    return sample_rows(points, row_id, kpi.scatter_points, kpi.scatter_seed)


def temperature_quartiles(
    sensors: DataFrame, kpi: KpiSettings = DEFAULT_KPI, strategy: str = "auto", limits: SizeLimits = SizeLimits()
) -> DataFrame:
    """Exact quartiles of the plottable temperatures per machine."""
    plottable = sensors.filter(F.col("temperature_c").between(kpi.plot_low_c, kpi.plot_high_c))
    return quantiles(plottable, MACHINE, "temperature_c", QUARTILES, strategy, limits)


def temperature_histogram(sensors: DataFrame, width: float = 5.0, kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    """Shape of the plottable temperatures per machine: at most (high-low)/width+1 bins each."""
    plottable = sensors.filter(F.col("temperature_c").between(kpi.plot_low_c, kpi.plot_high_c))
    return histogram(plottable, MACHINE, "temperature_c", width)


def cost_split(maintenance_cost: DataFrame, kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    """Total cost shared between preventive and corrective work by number of interventions."""
    preventive, corrective = F.col("nb_interventions_preventives"), F.col("nb_interventions_correctives")
    share = ratio(F.col("cout_total_eur") * preventive, preventive + corrective)
    totals = maintenance_cost.agg(
        stable_sum("cout_total_eur", kpi.sum_scale).alias("cout_total"),
        stable_sum(share, kpi.sum_scale).alias("cout_preventif"),
    )
    return totals.withColumn("cout_correctif", F.col("cout_total") - F.col("cout_preventif"))


def mtbf_ranking(maintenance_cost: DataFrame, kpi: KpiSettings = DEFAULT_KPI) -> DataFrame:
    """Machines that have failed, least reliable first."""
    ranked = maintenance_cost.dropna(subset=["mtbf_heures"]).select(MACHINE, "mtbf_heures")
    return ranked.withColumn("objectif_mtbf", threshold_status("mtbf_heures", kpi.mtbf_target_hours)).orderBy(
        "mtbf_heures", MACHINE
    )


def quality_report(sensors_bronze: DataFrame, sensors_silver: DataFrame) -> DataFrame:
    """Readings before and after deduplication, anomalies and labels; one pass over each table."""
    before = sensors_bronze.agg(F.count(F.lit(1)).alias("n_avant"))
    label = F.col("qualite_donnee")
    after = sensors_silver.agg(
        F.count(F.lit(1)).alias("n_apres"),
        F.count(F.when(F.col("anomalie_detectee"), 1)).alias("n_anomalies"),
        F.count(F.when(F.col("timestamp_clean").isNull(), 1)).alias("n_sans_date"),
        *[F.count(F.when(label == name, 1)).alias(f"n_{name.lower()}") for name in ("VALID", "INTERPOLATED", "INVALID")],
    )
    return side_by_side(before, after).withColumns(
        {
            "n_doublons": F.col("n_avant") - F.col("n_apres"),
            "pct_anomalies": ratio(F.col("n_anomalies") * F.lit(100.0), "n_apres"),
        }
    )


def run_summary(
    sensors: DataFrame,
    scada: DataFrame,
    mes: DataFrame,
    maintenance: DataFrame,
    oee: DataFrame,
    maintenance_cost: DataFrame,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Rows ingested, raw anomaly rate of temperature and vibration, mean OEE and total maintenance cost."""
    kpi = settings.kpi
    rules = [rule for rule in settings.range_rules if rule.column in ("temperature_c", "vibration_mms")]
    numbers = sensors.withColumns({rule.column: to_number(rule.column) for rule in rules})
    readings = numbers.agg(
        F.count(F.lit(1)).alias("n_capteurs"), F.coalesce(count_if(anomaly_known(rules)), F.lit(0)).alias("n_anomalies")
    )
    others = [df.agg(F.count(F.lit(1)).alias(f"_n{i}")) for i, df in enumerate((scada, mes, maintenance))]
    rates = oee.agg(stable_avg("oee_pct", kpi.sum_scale).alias("oee_moyen_pct"))
    costs = maintenance_cost.agg(stable_sum("cout_total_eur", kpi.sum_scale).alias("cout_total_eur"))
    return side_by_side(readings, *others, rates, costs).select(
        (F.col("n_capteurs") + F.col("_n0") + F.col("_n1") + F.col("_n2")).alias("n_bronze"),
        "n_capteurs",
        "n_anomalies",
        F.coalesce(ratio(F.col("n_anomalies") * F.lit(100.0), "n_capteurs"), F.lit(0.0)).alias("pct_anomalies"),
        "oee_moyen_pct",
        "cout_total_eur",
    )
