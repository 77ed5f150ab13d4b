"""The same queries as SQL for DuckDB, written from the definitions and not from the Spark code."""

from __future__ import annotations

import re

# Doubles meet decimals and rounding through their shortest text, where both engines agree.


def dec(x: str, scale: int = 6) -> str:
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(28,{scale}))"


def total(x: str) -> str:
    return f"CAST(CAST(SUM({dec(x)}) AS VARCHAR) AS DOUBLE)"


def mean(x: str) -> str:
    return f"({total(x)} / NULLIF(COUNT({x}), 0))"


def round2(x: str) -> str:
    return f"CAST(CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2) AS VARCHAR) AS DOUBLE)"


CTES: dict[str, str] = {}

CTES["ev"] = """
SELECT event_id, ts, concat('M', user_id) AS machine_id, event_type, value,
  CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
FROM events"""

CTES["ev_text"] = """
SELECT *,
  CASE WHEN k < 40 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
       WHEN k < 80 THEN strftime(ts, '%d/%m/%Y %H:%M')
       WHEN k < 86 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
       WHEN k < 92 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
       WHEN k < 98 THEN strftime(ts, '%d/%m/%Y %H:%M:%S')
       ELSE concat('n/a ', event_id) END AS "timestamp",
  CASE WHEN k < 40 THEN date_trunc('second', ts)
       WHEN k < 80 THEN date_trunc('minute', ts)
       WHEN k < 98 THEN date_trunc('second', ts) END AS timestamp_clean,
  CASE WHEN k < 40 THEN date_trunc('second', ts)
       WHEN k < 80 THEN date_trunc('minute', ts)
       WHEN k < 98 THEN date_trunc('second', ts) END AS timestamp_exact
FROM ev"""

CTES["raw_sensors"] = """
SELECT "timestamp", machine_id,
  CASE WHEN k NOT BETWEEN 10 AND 12 THEN value - 15e0 END AS temperature_c,
  CASE WHEN k NOT BETWEEN 20 AND 22 THEN value / 1e2 - 5e-2 END AS vibration_mms,
  CASE WHEN k NOT BETWEEN 30 AND 33 THEN CAST(k AS DOUBLE) / 1e1 - 1e-1 END AS pression_bar,
  CASE WHEN k NOT BETWEEN 41 AND 43 THEN CAST(k AS DOUBLE) END AS courant_a,
  'OK' AS statut_capteur, event_id * 2 AS _row_id, timestamp_clean, timestamp_exact
FROM ev_text
UNION ALL
SELECT "timestamp", machine_id, value + 1e0, value / 1e2, 4e0, 12e0, 'OK', event_id * 2 + 1,
  timestamp_clean, timestamp_exact
FROM ev_text WHERE event_type = 'error'"""

CTES["raw_scada"] = """
SELECT concat('EVT_', event_id) AS event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", machine_id,
  CASE event_type WHEN 'error' THEN 'ALARME' WHEN 'purchase' THEN 'ARRET' WHEN 'signup' THEN 'MAINTENANCE'
    ELSE 'EN_MARCHE' END AS etat,
  concat('OP_', k) AS operateur_id,
  CASE WHEN event_type = 'error' THEN concat('alm_', k // 10) END AS code_alarme,
  concat('état ', event_type) AS description, event_id * 2 AS _row_id, date_trunc('second', ts) AS timestamp_clean
FROM ev
UNION ALL
SELECT concat('EVT_', event_id), strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), machine_id, 'ALARME', concat('OP_', k),
  'alm_copy', concat('état ', event_type), event_id * 2 + 1, date_trunc('second', ts)
FROM ev WHERE event_type = 'error'"""

CTES["raw_mes"] = """
SELECT concat('ORD_', l_orderkey, '_', l_linenumber) AS ordre_id, concat('PROD_', o_orderpriority[1]) AS produit_id,
  concat('M', l_suppkey) AS machine_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS date_debut,
  strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%dT%H:%M:%S') AS date_fin_prevue,
  CASE WHEN l_linestatus <> 'O' THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') END AS date_fin_reelle,
  CAST(l_quantity AS INTEGER) AS quantite_prevue,
  CAST(floor(l_quantity * (1e0 - l_discount)) AS INTEGER) AS quantite_produite,
  l_tax * 1e2 AS taux_rebut_pct,
  date_trunc('second', o_orderdate) AS date_debut_clean,
  date_trunc('second', o_orderdate + INTERVAL 30 DAY) AS date_fin_prevue_clean,
  CASE WHEN l_linestatus <> 'O' THEN date_trunc('second', l_shipdate) END AS date_fin_reelle_clean
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["raw_maintenance"] = """
SELECT concat('INT_', l_orderkey, '_', l_linenumber) AS intervention_id,
  strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS date_intervention, concat('M', l_suppkey) AS machine_id,
  CASE WHEN l_returnflag = 'R' THEN 'CORRECTIVE' ELSE 'PREVENTIVE' END AS type_intervention,
  l_quantity AS duree_heures, concat('TECH_', l_linenumber) AS technicien_id, l_extendedprice AS cout_eur,
  concat('panne "', l_returnflag, '", pièce') AS description_panne,
  CASE WHEN l_linestatus = 'O' THEN concat('pièce / ', l_partkey) END AS pieces_changees
FROM lineitem"""

CTES["flagged"] = """
SELECT *, is_temp_invalid OR is_vibration_invalid OR is_pression_invalid AS anomalie_detectee
FROM (SELECT *, temperature_c < -1e1 OR temperature_c > 12e1 AS is_temp_invalid,
        vibration_mms < 0e0 AS is_vibration_invalid, pression_bar < 0e0 AS is_pression_invalid FROM raw_sensors)"""

CTES["uniq"] = """
SELECT * FROM flagged QUALIFY row_number() OVER (PARTITION BY machine_id, "timestamp" ORDER BY _row_id) = 1"""

_FILL = "last_value({c} IGNORE NULLS) OVER so_far AS {f}"
_PAIRS = [
    ("temperature_c", "temperature_filled"),
    ("vibration_mms", "vibration_filled"),
    ("pression_bar", "pression_filled"),
    ("courant_a", "courant_filled"),
]
_WAS_NULL = ", ".join(f"{c} IS NULL AND {f} IS NOT NULL AS {c}_was_null" for c, f in _PAIRS)

CTES["filled"] = f"""
SELECT *, {_WAS_NULL} FROM (
  SELECT *, {", ".join(_FILL.format(c=c, f=f) for c, f in _PAIRS)} FROM uniq
  WINDOW so_far AS (PARTITION BY machine_id ORDER BY timestamp_clean NULLS FIRST, _row_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

CTES["sensors"] = f"""
SELECT *, CASE WHEN anomalie_detectee THEN 'INVALID' WHEN any_was_null THEN 'INTERPOLATED' ELSE 'VALID' END
  AS qualite_donnee
FROM (SELECT *, {" OR ".join(f"{c}_was_null" for c, _ in _PAIRS)} AS any_was_null FROM filled)"""

CTES["scada_uniq"] = """
SELECT * FROM raw_scada QUALIFY row_number() OVER (PARTITION BY machine_id, "timestamp", etat ORDER BY _row_id) = 1"""

CTES["scada"] = """
SELECT * REPLACE (upper(code_alarme) AS code_alarme),
  CAST(epoch(next_timestamp) - epoch(timestamp_clean) AS BIGINT) / 6e1 AS duree_etat_minutes
FROM (SELECT *, lead(timestamp_clean) OVER (PARTITION BY machine_id ORDER BY timestamp_clean NULLS FIRST, _row_id)
        AS next_timestamp FROM scada_uniq)"""

CTES["mes"] = """
SELECT *, CASE WHEN date_fin_reelle_clean IS NULL THEN 'EN_COURS' WHEN retard_heures > 0 THEN 'EN_RETARD'
    ELSE 'A_TEMPS' END AS ordre_statut
FROM (SELECT *, CAST(epoch(date_fin_reelle_clean) - epoch(date_fin_prevue_clean) AS BIGINT) / 36e2 AS retard_heures,
        CAST(quantite_produite AS DOUBLE) / NULLIF(CAST(quantite_prevue AS DOUBLE), 0e0) * 1e2 AS taux_rendement_pct
      FROM raw_mes)"""

_STOPPED = "CASE WHEN etat = 'ARRET' THEN duree_etat_minutes ELSE 0e0 END"

CTES["sensors_day"] = f"""
SELECT CAST(timestamp_clean AS DATE) AS date, machine_id, {mean("temperature_c")} AS temp_moyenne,
  MAX(temperature_c) AS temp_max, {mean("vibration_mms")} AS vibration_moyenne,
  {mean("pression_bar")} AS pression_moyenne,
  CAST(SUM(CASE WHEN anomalie_detectee THEN 1 ELSE 0 END) AS BIGINT) AS nb_anomalies_capteurs, COUNT(*) AS nb_mesures
FROM sensors GROUP BY ALL"""

CTES["states_day"] = f"""
SELECT CAST(timestamp_clean AS DATE) AS date, machine_id,
  CAST(SUM(CASE WHEN etat = 'ALARME' THEN 1 ELSE 0 END) AS BIGINT) AS nb_alarmes,
  {total(_STOPPED)} AS duree_arret_minutes
FROM scada GROUP BY ALL"""

CTES["days"] = "SELECT * FROM sensors_day LEFT JOIN states_day USING (date, machine_id)"

CTES["kpis"] = """
SELECT *, least(1e2, greatest(0e0, (144e1 - duree_arret_minutes) / 144e1 * 1e2)) AS taux_disponibilite_pct
FROM (SELECT * REPLACE (coalesce(nb_alarmes, 0) AS nb_alarmes, coalesce(duree_arret_minutes, 0e0) AS duree_arret_minutes)
      FROM days)"""

CTES["sensors_week"] = """
SELECT CAST(weekofyear(timestamp_clean) AS INTEGER) AS semaine, machine_id, COUNT(*) AS nb_mesures_semaine
FROM sensors GROUP BY ALL"""

CTES["downtime_week"] = f"""
SELECT CAST(weekofyear(timestamp_clean) AS INTEGER) AS semaine, machine_id, {total(_STOPPED)} AS sum_arret_minutes
FROM scada GROUP BY ALL"""

CTES["production_week"] = f"""
SELECT CAST(weekofyear(date_debut_clean) AS INTEGER) AS semaine, machine_id,
  CAST(SUM(quantite_produite) AS BIGINT) AS sum_produite, CAST(SUM(quantite_prevue) AS BIGINT) AS sum_prevue,
  {total("quantite_produite * taux_rebut_pct / 1e2")} AS sum_rebuts
FROM mes GROUP BY ALL"""

CTES["weeks"] = """
SELECT * FROM sensors_week LEFT JOIN downtime_week USING (semaine, machine_id)
LEFT JOIN production_week USING (semaine, machine_id)"""

CTES["oee"] = f"""
SELECT semaine, machine_id, nb_mesures_semaine, sum_arret_minutes, sum_produite, sum_prevue, sum_rebuts,
  {round2("d * 100")} AS disponibilite, h AS temps_disponible_heures, {round2("p * 100")} AS performance,
  {round2("q * 100")} AS qualite_oee, {round2("least(1e2, greatest(0e0, d * p * q * 1e2))")} AS oee_pct
FROM (SELECT *, least(1e0, greatest(0e0, sum_produite / NULLIF(5e2 * h, 0e0))) AS p,
    least(1e0, greatest(0e0, (sum_produite - sum_rebuts) / NULLIF(CAST(sum_produite AS DOUBLE), 0e0))) AS q
  FROM (SELECT *, least(1e0, greatest(0e0, (1008e1 - sum_arret_minutes) / 1008e1)) AS d,
      (1008e1 - sum_arret_minutes) / 6e1 AS h
    FROM (SELECT semaine, machine_id, nb_mesures_semaine, coalesce(sum_arret_minutes, 0e0) AS sum_arret_minutes,
        coalesce(sum_produite, 0) AS sum_produite, coalesce(sum_prevue, 1) AS sum_prevue,
        coalesce(sum_rebuts, 0e0) AS sum_rebuts FROM weeks)))"""

CTES["costs"] = f"""
SELECT * REPLACE ({round2("cout_total_eur")} AS cout_total_eur, {round2("mttr_heures")} AS mttr_heures),
  {round2("72e1 / NULLIF(CAST(nb_interventions_correctives AS DOUBLE), 0e0)")} AS mtbf_heures
FROM (SELECT machine_id,
    CAST(SUM(CASE WHEN type_intervention = 'PREVENTIVE' THEN 1 ELSE 0 END) AS BIGINT) AS nb_interventions_preventives,
    CAST(SUM(CASE WHEN type_intervention = 'CORRECTIVE' THEN 1 ELSE 0 END) AS BIGINT) AS nb_interventions_correctives,
    {total("cout_eur")} AS cout_total_eur, {total("duree_heures")} AS duree_totale_heures,
    {mean("CASE WHEN type_intervention = 'CORRECTIVE' THEN duree_heures END")} AS mttr_heures
  FROM raw_maintenance GROUP BY machine_id)"""

CTES["near"] = """
SELECT s._row_id, s.machine_id, s.timestamp_clean, s.temperature_c, c.timestamp_clean AS scada_ts, c.event_id,
  c.code_alarme
FROM uniq s LEFT JOIN scada c
  ON s.machine_id = c.machine_id AND abs(epoch(s.timestamp_clean) - epoch(c.timestamp_clean)) <= 300"""

CTES["enriched"] = """
SELECT s.machine_id, s.timestamp_clean, s.temperature_filled, s.vibration_filled, s.pression_filled,
  s.courant_filled, s.anomalie_detectee, s.qualite_donnee, c.timestamp_clean AS scada_ts, c.etat, c.code_alarme,
  c.duree_etat_minutes
FROM sensors s LEFT JOIN scada c
  ON s.machine_id = c.machine_id AND abs(epoch(s.timestamp_clean) - epoch(c.timestamp_clean)) <= 300"""

CTES["plottable"] = "SELECT * FROM raw_sensors WHERE temperature_c BETWEEN -1e1 AND 13e1"

CTES["ranked"] = """
SELECT machine_id, temperature_c, row_number() OVER (PARTITION BY machine_id ORDER BY temperature_c) - 1 AS r,
  COUNT(*) OVER (PARTITION BY machine_id) AS n
FROM plottable"""

CTES["known"] = """
SELECT *, coalesce(temperature_c < -1e1 OR temperature_c > 12e1, FALSE) OR coalesce(vibration_mms < 0e0, FALSE)
  AS anomalie_connue
FROM raw_sensors"""

CTES["points"] = """
SELECT _row_id, machine_id, temperature_c, vibration_mms, anomalie_connue AS anomalie_detectee,
  temperature_c > 95e0 AS surchauffe
FROM known WHERE temperature_c IS NOT NULL AND vibration_mms IS NOT NULL"""


def _needs(sql: str, found: list[str]) -> list[str]:
    """Names of the CTEs ``sql`` reads, directly or not, each after those it reads itself."""
    for name in re.findall(r"(?:FROM|JOIN)\s+([a-z_]+)", sql):
        if name in CTES and name not in found:
            _needs(CTES[name], found)
            found.append(name)
    return found


def _with(sql: str) -> str:
    names = _needs(sql, [])
    if not names:
        return sql
    # Spelled out once, since several queries would otherwise evaluate an input per use.
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in names) + "\n" + sql


def _quantile(p: float) -> str:
    position = f"((n - 1) * CAST({p} AS DOUBLE))"
    low = f"MAX(CASE WHEN r = floor({position}) THEN temperature_c END)"
    high = f"MAX(CASE WHEN r = ceil({position}) THEN temperature_c END)"
    share = f"MAX({position} - floor({position}))"
    return f"{low} + ({high} - {low}) * {share}"


_QUARTILES = f"""SELECT machine_id, MAX(n) AS n_values, {_quantile(0.25)} AS q1, {_quantile(0.5)} AS median,
  {_quantile(0.75)} AS q3 FROM ranked GROUP BY machine_id"""

_RAW_SENSORS = '"timestamp", machine_id, temperature_c, vibration_mms, pression_bar, courant_a, statut_capteur'
_RAW_SCADA = 'event_id, "timestamp", machine_id, etat, operateur_id, code_alarme, description'
_RAW_MES = (
    "ordre_id, produit_id, machine_id, date_debut, date_fin_prevue, date_fin_reelle, quantite_prevue, "
    "quantite_produite, taux_rebut_pct"
)
_FILLED = ", ".join(f for _, f in _PAIRS) + ", " + ", ".join(f"{c}_was_null" for c, _ in _PAIRS)
_SENSOR_COLUMNS = (
    f"{_RAW_SENSORS}, _row_id, timestamp_clean, is_temp_invalid, is_vibration_invalid, is_pression_invalid, "
    f"anomalie_detectee, {_FILLED}, any_was_null, qualite_donnee"
)


def _bronze(system: str, file: str, table: str, columns: str) -> str:
    filled = " + ".join(f"COUNT({c.strip()})" for c in columns.split(","))
    return (
        f"SELECT '{system}' AS _source_system, '{file}' AS _source_file, COUNT(*) AS n_rows, {filled} AS n_values, "
        f"MIN(machine_id) AS first_machine, MAX(machine_id) AS last_machine FROM {table}"
    )


_MAINTENANCE = (
    "intervention_id, date_intervention, machine_id, type_intervention, duree_heures, technicien_id, cout_eur, "
    "description_panne, pieces_changees"
)


def _rows(stage: str, table: str, source: str) -> str:
    return f"""SELECT '{stage}' AS stage, '{table}' AS "table", COUNT(*) AS "rows", 'OK' AS status FROM {source}"""


_STAGES = [
    ("bronze", "sensors", "raw_sensors"),
    ("bronze", "scada", "raw_scada"),
    ("bronze", "mes", "raw_mes"),
    ("bronze", "maintenance", "raw_maintenance"),
    ("silver", "sensors_silver", "sensors"),
    ("silver", "scada_silver", "scada"),
    ("silver", "mes_silver", "mes"),
    ("silver", "maintenance_silver", "raw_maintenance"),
    ("silver", "sensors_enriched", "enriched"),
    ("gold", "gold_kpis_machines", "kpis"),
    ("gold", "gold_oee", "oee"),
    ("gold", "gold_maintenance_cost", "costs"),
    ("gold", "gold_production_summary", "(SELECT DISTINCT month(date_debut_clean), produit_id FROM mes)"),
    ("dashboards", "sensor_series", "kpis"),
    ("dashboards", "hottest_day", "(SELECT DISTINCT machine_id FROM kpis)"),
    ("dashboards", "alarm_table", "(SELECT DISTINCT date, machine_id FROM kpis WHERE date IS NOT NULL)"),
    ("dashboards", "oee_heatmap", "(SELECT DISTINCT machine_id FROM oee)"),
    ("dashboards", "oee_components", "(SELECT DISTINCT machine_id FROM oee)"),
    ("dashboards", "oee_targets", "oee"),
    (
        "dashboards",
        "anomaly_points",
        "(SELECT 1 FROM sensors WHERE temperature_c IS NOT NULL AND vibration_mms IS NOT NULL LIMIT 5000)",
    ),
    (
        "dashboards",
        "temperature_quartiles",
        "(SELECT DISTINCT machine_id FROM sensors WHERE temperature_c BETWEEN -1e1 AND 13e1)",
    ),
    (
        "dashboards",
        "temperature_histogram",
        "(SELECT DISTINCT machine_id, floor(temperature_c / 5e0) FROM sensors WHERE temperature_c BETWEEN -1e1 AND 13e1)",
    ),
    ("dashboards", "cost_split", "(SELECT 1)"),
    ("dashboards", "mtbf_ranking", "(SELECT 1 FROM costs WHERE mtbf_heures IS NOT NULL)"),
    ("dashboards", "quality_report", "(SELECT 1)"),
    ("summary", "run_summary", "(SELECT 1)"),
]

_SHARE = (
    "cout_total_eur * nb_interventions_preventives / "
    "NULLIF(CAST(nb_interventions_preventives + nb_interventions_correctives AS DOUBLE), 0e0)"
)

_SQL: dict[str, str] = {
    "scan_csv": f"SELECT {_RAW_SENSORS} FROM raw_sensors",
    "scan_json": f"SELECT {_RAW_SCADA} FROM raw_scada",
    "scan_json_lines": f"SELECT {_RAW_SCADA} FROM raw_scada",
    "scan_csv_reordered": f"SELECT {_RAW_SENSORS} FROM raw_sensors",
    "bronze_scada_lines": f"SELECT {_RAW_SCADA}, 'scada_logs.json' AS _source_file, 'SCADA' AS _source_system FROM raw_scada",
    "parse_timestamps_with_zone_and_fraction": "SELECT event_id, date_trunc('second', ts) - INTERVAL 2 HOUR "
    "AS timestamp_clean FROM events",
    "scan_layer_table": f"SELECT {_RAW_MES} FROM raw_mes",
    "sink_partitioned_roundtrip": "SELECT *, 'maintenance_logs.csv' AS _source_file, 'MAINTENANCE' AS _source_system "
    "FROM raw_maintenance",
    "sink_overwrite_roundtrip": "SELECT intervention_id, machine_id, cout_eur FROM raw_maintenance",
    "sink_csv_export_roundtrip": "SELECT * FROM costs",
    "preview_limit": "SELECT machine_id, intervention_id, cout_eur FROM raw_maintenance "
    "ORDER BY machine_id, intervention_id, cout_eur LIMIT 10",
    "add_lineage": "SELECT event_id, code_alarme, 'scada_logs.json' AS _source_file, 'SCADA' AS _source_system, "
    "TRUE AS has_time, TRUE AS has_id FROM raw_scada",
    "cast_coerce": 'SELECT _row_id, TRY_CAST("timestamp"[1:4] AS DOUBLE) AS head_number, '
    "CAST(_row_id AS VARCHAR) AS row_text, CAST(temperature_c IS NULL AS INTEGER) AS missing, "
    "CAST(NULL AS DOUBLE) AS nothing FROM raw_sensors",
    "quality_label": "SELECT _row_id, anomalie_detectee, any_was_null, qualite_donnee FROM sensors",
    "order_status": "SELECT ordre_id, machine_id, date_fin_reelle_clean, ordre_statut FROM mes",
    "order_delay_hours": "SELECT ordre_id, date_fin_prevue_clean, date_fin_reelle_clean, retard_heures FROM mes",
    "yield_pct": "SELECT ordre_id, quantite_prevue, quantite_produite, taux_rendement_pct FROM mes",
    "clamp_expr": "SELECT _row_id, least(1e2, greatest(0e0, temperature_c)) AS bounded, "
    "least(1e0, greatest(0e0, temperature_c / NULLIF(floor(pression_bar), 0e0))) AS bounded_ratio, "
    "abs(temperature_c) AS size FROM raw_sensors",
    "threshold_status": "SELECT machine_id, semaine, oee_pct, "
    "CASE WHEN oee_pct >= 85e0 THEN 'OK' WHEN oee_pct < 85e0 THEN 'KO' END AS objectif_oee FROM oee",
    "anomaly_flags": "SELECT _row_id, is_temp_invalid, is_vibration_invalid, is_pression_invalid, anomalie_detectee "
    "FROM flagged",
    "filter_anomalies": "SELECT _row_id, temperature_c, vibration_mms, pression_bar FROM flagged WHERE anomalie_detectee",
    "anomaly_flags_two_valued": "SELECT _row_id, anomalie_connue AS anomalie_detectee FROM known",
    "fill_defaults": "SELECT date, machine_id, nb_alarmes, duree_arret_minutes FROM kpis",
    "dropna_subset": "SELECT _row_id, temperature_c, vibration_mms, pression_bar FROM raw_sensors "
    "WHERE temperature_c IS NOT NULL AND vibration_mms IS NOT NULL",
    "filter_between": "SELECT _row_id, temperature_c FROM plottable",
    "range_join_left": "SELECT * FROM near",
    "range_join_naive": "SELECT * FROM near",
    "range_join_salted": "SELECT * FROM near",
    "left_join_daily": "SELECT * FROM days",
    "left_join_chain_weekly": "SELECT * FROM weeks",
    "dedup_keep_first": 'SELECT _row_id, machine_id, "timestamp", temperature_c, pression_bar FROM uniq',
    "dedup_three_keys": 'SELECT _row_id, event_id, machine_id, "timestamp", etat, code_alarme FROM scada_uniq',
    "category_counts": "SELECT qualite_donnee AS label, COUNT(*) AS n FROM sensors GROUP BY 1 "
    "UNION ALL SELECT etat, COUNT(*) FROM scada GROUP BY 1 UNION ALL SELECT ordre_statut, COUNT(*) FROM mes GROUP BY 1",
    "daily_sensor_agg": "SELECT * FROM sensors_day",
    "daily_state_agg": "SELECT * FROM states_day",
    "weekly_count": "SELECT * FROM sensors_week",
    "weekly_downtime": "SELECT * FROM downtime_week",
    "weekly_production": "SELECT * FROM production_week",
    "quality_report": "SELECT n_avant, n_apres, n_anomalies, n_sans_date, n_valid, n_interpolated, n_invalid, "
    "n_avant - n_apres AS n_doublons, n_anomalies * 1e2 / NULLIF(CAST(n_apres AS DOUBLE), 0e0) AS pct_anomalies "
    "FROM (SELECT COUNT(*) AS n_apres, COUNT(*) FILTER (anomalie_detectee) AS n_anomalies, "
    "COUNT(*) FILTER (timestamp_clean IS NULL) AS n_sans_date, COUNT(*) FILTER (qualite_donnee = 'VALID') AS n_valid, "
    "COUNT(*) FILTER (qualite_donnee = 'INTERPOLATED') AS n_interpolated, "
    "COUNT(*) FILTER (qualite_donnee = 'INVALID') AS n_invalid FROM sensors), "
    "(SELECT COUNT(*) AS n_avant FROM raw_sensors)",
    "pivot_alarms": "SELECT strftime(timestamp_clean, '%Y-%m-%d') AS jour, "
    + ", ".join(f"COUNT(*) FILTER (code_alarme = 'ALM_{i}') AS \"ALM_{i}\"" for i in range(10))
    + ", COUNT(*) FILTER (coalesce(code_alarme, '') NOT IN ("
    + ", ".join(f"'ALM_{i}'" for i in range(10))
    + ")) AS autres FROM scada WHERE etat = 'ALARME' AND timestamp_clean IS NOT NULL GROUP BY 1",
    "pivot_alarms_by_machine": "SELECT strftime(date, '%Y-%m-%d') AS jour, machine_id, "
    "CAST(SUM(nb_alarmes) AS BIGINT) AS nb_alarmes FROM kpis WHERE date IS NOT NULL GROUP BY ALL",
    "pivot_oee": "SELECT machine_id, "
    + ", ".join(f'{mean(f"CASE WHEN semaine = {w} THEN oee_pct END")} AS "{w}"' for w in range(1, 54))
    + " FROM oee GROUP BY 1",
    "oee_components_by_machine": f"SELECT machine_id, {mean('disponibilite')} AS disponibilite, "
    f"{mean('performance')} AS performance, {mean('qualite_oee')} AS qualite_oee FROM oee GROUP BY 1",
    "argmax_per_group": "SELECT machine_id, CASE WHEN temp_max IS NOT NULL THEN date END AS date, temp_max FROM kpis "
    "QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY temp_max DESC NULLS LAST, date NULLS FIRST) = 1",
    "distinct_keys": "SELECT DISTINCT machine_id FROM raw_sensors",
    "run_summary": "SELECT n_capteurs + n_scada + n_mes + n_maintenance AS n_bronze, n_capteurs, n_anomalies, "
    "n_anomalies * 1e2 / n_capteurs AS pct_anomalies, oee_moyen_pct, cout_total_eur FROM "
    "(SELECT COUNT(*) AS n_capteurs, COUNT(*) FILTER (anomalie_connue) AS n_anomalies FROM known), "
    "(SELECT COUNT(*) AS n_scada FROM raw_scada), (SELECT COUNT(*) AS n_mes FROM raw_mes), "
    "(SELECT COUNT(*) AS n_maintenance FROM raw_maintenance), "
    f"(SELECT {mean('oee_pct')} AS oee_moyen_pct FROM oee), (SELECT {total('cout_total_eur')} AS cout_total_eur FROM costs)",
    "cost_split": "SELECT cout_total, cout_preventif, cout_total - cout_preventif AS cout_correctif FROM "
    f"(SELECT {total('cout_total_eur')} AS cout_total, {total(_SHARE)} AS cout_preventif FROM costs)",
    "distribution_by_group": _QUARTILES,
    "distribution_by_group_chunked": _QUARTILES,
    "distribution_by_group_selected": _QUARTILES,
    "histogram_by_group": "SELECT machine_id, CAST(floor(temperature_c / 5e0) AS BIGINT) AS bin, COUNT(*) AS n "
    "FROM plottable GROUP BY 1, 2",
    "sample_bounded": "SELECT * FROM points ORDER BY md5(concat(_row_id, '-', 42)), _row_id LIMIT 5000",
    "forward_fill": f"SELECT _row_id, {_FILLED} FROM filled",
    "forward_fill_two_level": f"SELECT _row_id, {_FILLED} FROM filled",
    "state_duration": "SELECT event_id, timestamp_clean, next_timestamp, duree_etat_minutes FROM scada",
    "state_duration_chunked": "SELECT event_id, timestamp_clean, next_timestamp, duree_etat_minutes FROM scada",
    "series_sorted": "SELECT machine_id, date, temp_moyenne, vibration_moyenne, taux_disponibilite_pct FROM kpis",
    "mtbf_ranking": "SELECT machine_id, mtbf_heures, CASE WHEN mtbf_heures >= 2e2 THEN 'OK' ELSE 'KO' END "
    "AS objectif_mtbf FROM costs WHERE mtbf_heures IS NOT NULL",
    "parse_mixed_timestamps": 'SELECT _row_id, "timestamp", timestamp_clean FROM raw_sensors',
    "parse_mixed_timestamps_exact": 'SELECT _row_id, "timestamp", timestamp_exact AS timestamp_clean FROM raw_sensors',
    "parse_mixed_timestamps_legacy": 'SELECT _row_id, "timestamp", CASE WHEN k >= 92 AND k < 98 '
    "THEN date_trunc('minute', timestamp_clean) ELSE timestamp_clean END AS timestamp_clean "
    'FROM raw_sensors JOIN (SELECT event_id, k FROM ev) ON event_id = _row_id // 2',
    "date_parts": "SELECT ordre_id, CAST(date_debut_clean AS DATE) AS jour, "
    "CAST(weekofyear(date_debut_clean) AS INTEGER) AS semaine, CAST(month(date_debut_clean) AS INTEGER) AS mois FROM mes",
    "date_format_label": "SELECT _row_id, strftime(timestamp_clean, '%Y-%m-%d') AS label, "
    "CAST(timestamp_clean AS DATE) AS jour FROM raw_sensors",
    "normalize_code": "SELECT _row_id, upper(code_alarme) AS code_alarme FROM raw_scada",
    "bronze_ingest": " UNION ALL ".join(
        [
            _bronze("IOT", "sensors_data.csv", "raw_sensors", _RAW_SENSORS),
            _bronze("SCADA", "scada_logs.json", "raw_scada", _RAW_SCADA),
            _bronze("MES", "mes_orders.csv", "raw_mes", _RAW_MES),
            _bronze("MAINTENANCE", "maintenance_logs.csv", "raw_maintenance", _MAINTENANCE),
        ]
    ),
    "bronze_sensors": f"SELECT {_RAW_SENSORS} FROM raw_sensors",
    "bronze_scada": f"SELECT {_RAW_SCADA} FROM raw_scada",
    "bronze_mes": f"SELECT {_RAW_MES} FROM raw_mes",
    "bronze_maintenance": f"SELECT {_MAINTENANCE} FROM raw_maintenance",
    "bronze_bad_rows": """SELECT 'sensors' AS source, COUNT(*) FILTER (bad) AS n_bad, COUNT(*) FILTER (bad) AS n_readable,
      COUNT(*) FILTER (bad) AS n_texts, COUNT(*) FILTER (NOT bad) AS n_rows,
      COUNT(*) FILTER (NOT bad) AS counted_rows, COUNT(*) FILTER (bad) AS counted_bad
    FROM (SELECT *, _row_id % 50 = 1 AS bad FROM raw_sensors)
    UNION ALL SELECT 'scada', COUNT(*) FILTER (bad), CAST(0 AS BIGINT), COUNT(*) FILTER (bad),
      COUNT(*) FILTER (NOT bad), COUNT(*) FILTER (NOT bad), COUNT(*) FILTER (bad)
    FROM (SELECT *, _row_id % 40 = 0 AS bad FROM raw_scada)""",
    "bronze_keeps_bad_rows": """SELECT "timestamp", machine_id, CASE WHEN _row_id % 50 <> 1 THEN temperature_c END AS temperature_c,
      CAST(NULL AS VARCHAR) AS event_id FROM raw_sensors
    UNION ALL SELECT CASE WHEN _row_id % 40 <> 0 THEN "timestamp" END, CASE WHEN _row_id % 40 <> 0 THEN machine_id END, NULL,
      CASE WHEN _row_id % 40 <> 0 THEN event_id END FROM raw_scada""",
    "silver_days_rewritten": "SELECT event_id, CAST(timestamp_clean AS DATE) AS jour, etat, timestamp_clean FROM scada s "
    "WHERE etat = 'ALARME' OR CAST(timestamp_clean AS DATE) < DATE '2024-01-10' OR CAST(timestamp_clean AS DATE) NOT IN "
    "(SELECT CAST(timestamp_clean AS DATE) FROM scada WHERE etat = 'ALARME' AND timestamp_clean IS NOT NULL)",
    "gold_kpis_of_two_days": "SELECT * FROM kpis WHERE date IN (DATE '2024-01-05', DATE '2024-01-06')",
    "gold_kpis_bucketed": "SELECT * FROM kpis",
    "charts_in_order": """SELECT 'sensor_series' AS chart, row_number() OVER (ORDER BY machine_id, date NULLS FIRST) AS position,
      machine_id, date IS NULL AS unknown FROM kpis
    UNION ALL SELECT 'oee_targets', row_number() OVER (ORDER BY machine_id, semaine NULLS FIRST), machine_id, semaine IS NULL FROM oee
    UNION ALL SELECT 'mtbf_ranking', row_number() OVER (ORDER BY mtbf_heures, machine_id), machine_id, FALSE
    FROM costs WHERE mtbf_heures IS NOT NULL""",
    "silver_sensors_from_part_files": f"SELECT {_SENSOR_COLUMNS.replace('_row_id, ', '')} FROM sensors",
    "medallion_gold_oee": "SELECT * FROM oee",
    "medallion_gold_kpis": "SELECT * FROM kpis",
    "silver_sensors": f"SELECT {_SENSOR_COLUMNS} FROM sensors",
    "silver_sensors_chunked": f"SELECT {_SENSOR_COLUMNS} FROM sensors",
    "silver_scada": f"SELECT {_RAW_SCADA}, _row_id, timestamp_clean, next_timestamp, duree_etat_minutes FROM scada",
    "silver_mes": f"SELECT {_RAW_MES}, date_debut_clean, date_fin_prevue_clean, date_fin_reelle_clean, retard_heures, "
    "taux_rendement_pct, ordre_statut FROM mes",
    "silver_maintenance": "SELECT * FROM raw_maintenance",
    "sensors_enriched": "SELECT * FROM enriched",
    "gold_kpis_machines": "SELECT * FROM kpis",
    "gold_oee": "SELECT * FROM oee",
    "gold_maintenance_cost": "SELECT * FROM costs",
    "gold_production_summary": f"SELECT *, {round2('quantite_totale_produite / NULLIF(CAST(quantite_totale_prevue AS DOUBLE), 0e0) * 1e2')} "
    "AS taux_realisation_pct FROM (SELECT CAST(month(date_debut_clean) AS INTEGER) AS mois, produit_id, "
    "CAST(SUM(quantite_produite) AS BIGINT) AS quantite_totale_produite, "
    "CAST(SUM(quantite_prevue) AS BIGINT) AS quantite_totale_prevue, "
    f"{round2(mean('taux_rebut_pct'))} AS taux_rebut_moyen_pct, "
    "CAST(SUM(CASE WHEN ordre_statut = 'EN_RETARD' THEN 1 ELSE 0 END) AS BIGINT) AS nb_ordres_en_retard "
    "FROM mes GROUP BY 1, 2)",
    "medallion_run": " UNION ALL ".join(_rows(*stage) for stage in _STAGES),
    # bronze and silver are whole when gold breaks
    "medallion_resume": """SELECT stage, "table", "rows", CASE WHEN stage IN ('bronze', 'silver') THEN 'KEPT' ELSE 'OK' END AS status,
      TRUE AS broke_before FROM (""" + " UNION ALL ".join(_rows(*stage) for stage in _STAGES) + ")",
}

ORACLE_SQL = {name: _with(sql) for name, sql in _SQL.items()}

_ON_HOT = "CASE WHEN event_id % 3 = 0 THEN 'M0' ELSE concat('M', user_id) END AS machine_id"
for _name, _as in (
    ("silver_sensors_hot", "silver_sensors"),
    ("silver_sensors_hot_window", "silver_sensors"),
    ("distribution_by_group_hot", "distribution_by_group"),
):
    ORACLE_SQL[_name] = ORACLE_SQL[_as].replace("concat('M', user_id) AS machine_id", _ON_HOT)
