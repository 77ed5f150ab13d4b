"""Bronze to silver: parsed, deduplicated, flagged, filled and joined rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.config import DEFAULTS, Settings
from plantmetrics.functions.numeric import any_true, hours_between, minutes_between, percent
from plantmetrics.functions.timestamps import parse_timestamp
from plantmetrics.operators.cleaning import (
    flag_anomalies,
    order_status,
    out_of_range,
    quality_label,
    was_null,
)
from plantmetrics.operators.joins import range_join
from plantmetrics.operators.ordered import OrderedRows, forward_fill, next_value, order_unique

MACHINE, ROW_ID = "machine_id", "_row_id"


def _parse(df: DataFrame, settings: Settings, **columns: str) -> DataFrame:
    """Add a parsed column (keyword) for each text column (value)."""
    return df.withColumns(
        {
            new: parse_timestamp(text, settings.timestamp_formats, settings.timestamp_prefix)
            for new, text in columns.items()
        }
    )


def _clean_events(bronze: DataFrame, keys: tuple[str, ...], settings: Settings, strategy: str) -> OrderedRows:
    """Parse and deduplicate a machine feed, and order it per machine; rows move once."""
    if settings.dedup_on not in ("raw", "parsed"):
        raise ValueError(f"dedup_on must be 'raw' or 'parsed', not {settings.dedup_on!r}")
    instant = "timestamp" if settings.dedup_on == "raw" else "timestamp_clean"
    parsed = _parse(bronze, settings, timestamp_clean="timestamp")
    return order_unique(parsed, [MACHINE], [instant, *keys], ["timestamp_clean", ROW_ID], strategy, settings.limits)


def silver_sensors(bronze: DataFrame, settings: Settings = DEFAULTS, strategy: str = "auto") -> DataFrame:
    """Deduplicated readings with anomaly flags, filled measures and a quality label."""
    rows = _clean_events(bronze, (), settings, strategy)
    fills = settings.filled_columns
    sources = {column: F.col(column) for column in fills}
    if settings.exclude_invalid_from_fill:
        for rule in settings.range_rules:
            if rule.column in sources:
                sources[rule.column] = F.when(~out_of_range(rule), F.col(rule.column))
    filled = forward_fill(rows, {fills[column]: value for column, value in sources.items()})
    flagged = flag_anomalies(filled, settings.range_rules)
    null_flags = {f"{column}_was_null": was_null(column, name) for column, name in fills.items()}
    labelled = flagged.withColumns(null_flags).withColumn("any_was_null", any_true(list(null_flags)))
    return labelled.withColumn("qualite_donnee", quality_label("anomalie_detectee", "any_was_null"))


def silver_scada(bronze: DataFrame, settings: Settings = DEFAULTS, strategy: str = "auto") -> DataFrame:
    """Deduplicated state events with the time until the machine's next event."""
    upper = bronze.withColumn("code_alarme", F.upper("code_alarme"))
    rows = _clean_events(upper, ("etat",), settings, strategy)
    return state_duration(next_value(rows, "timestamp_clean", "next_timestamp"))


def state_duration(
    df: DataFrame, start: str = "timestamp_clean", end: str = "next_timestamp", name: str = "duree_etat_minutes"
) -> DataFrame:
    return df.withColumn(name, minutes_between(start, end))


def silver_mes(bronze: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Production orders with parsed dates, delay, yield and status."""
    parsed = _parse(
        bronze,
        settings,
        date_debut_clean="date_debut",
        date_fin_prevue_clean="date_fin_prevue",
        date_fin_reelle_clean="date_fin_reelle",
    )
    measured = parsed.withColumns(
        {
            "retard_heures": hours_between("date_fin_prevue_clean", "date_fin_reelle_clean"),
            "taux_rendement_pct": percent("quantite_produite", "quantite_prevue"),
        }
    )
    return measured.withColumn("ordre_statut", order_status("date_fin_reelle_clean", "retard_heures"))


def silver_maintenance(bronze: DataFrame) -> DataFrame:
    """Interventions as ingested."""
    return bronze


def sensors_enriched(
    sensors: DataFrame, scada: DataFrame, settings: Settings = DEFAULTS, strategy: str = "auto"
) -> DataFrame:
    """Each reading with the state events of its machine close in time; readings without one stay."""
    readings = sensors.select(
        MACHINE,
        "timestamp_clean",
        *settings.filled_columns.values(),
        "anomalie_detectee",
        "qualite_donnee",
        ROW_ID,
    )
    states = scada.select(
        MACHINE,
        F.col("timestamp_clean").alias("scada_ts"),
        "etat",
        "code_alarme",
        "duree_etat_minutes",
        F.col(ROW_ID).alias("_state_id"),
    )
    joined = range_join(
        readings,
        states,
        by=[MACHINE],
        left_ts="timestamp_clean",
        right_ts="scada_ts",
        tolerance_s=settings.join_tolerance_s,
        left_id=ROW_ID,
        right_id="_state_id",
        strategy=strategy,
        limits=settings.limits,
    )
    return joined.drop(ROW_ID, "_state_id")
