"""One query per operator and job, each over the whole test tables.

Totals of doubles use decimal sums (``sum_scale``), so that two engines agree to the last bit.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables
from plantmetrics import schemas
from plantmetrics.config import DEFAULTS, KpiSettings, SizeLimits
from plantmetrics.functions import numeric, timestamps
from plantmetrics.operators import aggregates, cleaning, joins, ordered
from plantmetrics.plans import bronze, dashboards, gold, run, silver
from plantmetrics.sources import scratch
from plantmetrics.sources import tables as io

KPI = KpiSettings(sum_scale=6)
SETTINGS = replace(DEFAULTS, kpi=KPI)
#: The machines of the test tables have some 80 readings: cut them all, or the one that gets a third of the feed.
SMALL_CHUNKS = SizeLimits(chunk_rows=40)
HOT_LIMITS = SizeLimits(max_group_rows=300, chunk_rows=300)
#: How raw feeds come.
PART_FILES = {"compression": "gzip", "rows_per_file": 500_000}
ALARM_CODES = [f"ALM_{i}" for i in range(10)]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Inputs shared by several queries


def _sensors(spark, sf):
    return silver.silver_sensors(tables.sensors(spark, sf), SETTINGS)


def _scada(spark, sf):
    return silver.silver_scada(tables.scada(spark, sf), SETTINGS)


def _mes(spark, sf):
    return silver.silver_mes(tables.mes(spark, sf), SETTINGS)


def _oee(spark, sf):
    return gold.gold_oee(_sensors(spark, sf), _scada(spark, sf), _mes(spark, sf), KPI)


def _kpis(spark, sf):
    return gold.gold_kpis_machines(_sensors(spark, sf), _scada(spark, sf), KPI)


def _costs(spark, sf):
    return gold.gold_maintenance_cost(tables.maintenance(spark, sf), KPI)


def _parsed(spark, sf):
    raw = tables.sensors(spark, sf)
    return raw.withColumn("timestamp_clean", timestamps.parse_timestamp("timestamp"))


def _unique(spark, sf):
    return cleaning.keep_first(_parsed(spark, sf), ["machine_id", "timestamp"], ["_row_id"])


def _flagged(spark, sf):
    return cleaning.flag_anomalies(tables.sensors(spark, sf), SETTINGS.range_rules)


# Sources and sinks


@query
def scan_csv(spark, sf):
    path = scratch.scratch_path(spark, "scan_csv")
    io.export_csv(tables.sensors(spark, sf).drop("_row_id"), path)
    return io.read_csv(spark, path, schemas.SENSORS)


@query
def scan_json(spark, sf):
    path = scratch.scratch_path(spark, "scan_json")
    tables.write_json_arrays(tables.scada(spark, sf).drop("_row_id"), path)
    return io.read_json(spark, path, schemas.SCADA)


@query
def scan_json_lines(spark, sf):
    path = scratch.scratch_path(spark, "scan_json_lines")
    tables.scada(spark, sf).drop("_row_id").write.json(path)
    return io.read_json(spark, path, schemas.SCADA, lines=True)


@query
def scan_csv_reordered(spark, sf):
    """Columns in another order than the schema's, and one that it doesn't know."""
    path = scratch.scratch_path(spark, "scan_csv_reordered")
    feed = tables.sensors(spark, sf).withColumn("autre", F.lit("x"))
    io.export_csv(feed.select("machine_id", "autre", *reversed(schemas.SENSORS.names[2:]), "timestamp"), path)
    return io.read_csv(spark, path, schemas.SENSORS)


@query
def bronze_scada_lines(spark, sf):
    folder = scratch.scratch_path(spark, "bronze_scada_lines")
    tables.scada(spark, sf).drop("_row_id").write.json(f"{folder}/scada_logs.json")
    (source,) = (s for s in bronze.sources(scada_lines=True) if s.table == "scada")
    return bronze.ingest(spark, source, folder).select(*schemas.SCADA.names, "_source_file", "_source_system")


@query
def parse_timestamps_with_zone_and_fraction(spark, sf):
    text = F.concat(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".25+02:00"))
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", text.alias("text"))
    return events.select("event_id", timestamps.parse_timestamp("text").alias("timestamp_clean"))


@query
def scan_layer_table(spark, sf):
    path = scratch.scratch_path(spark, "scan_layer_table")
    io.write_table(tables.mes(spark, sf), path)
    return io.read_table(spark, path)


@query
def sink_partitioned_roundtrip(spark, sf):
    path = scratch.scratch_path(spark, "sink_partitioned")
    feed = cleaning.add_lineage(tables.maintenance(spark, sf), "maintenance_logs.csv", "MAINTENANCE")
    bronze.write_bronze(feed, path)
    return io.read_table(spark, path).drop("_ingestion_timestamp", "_row_id")


@query
def sink_overwrite_roundtrip(spark, sf):
    path = scratch.scratch_path(spark, "sink_overwrite")
    io.write_table(tables.mes(spark, sf), path)
    io.write_table(tables.maintenance(spark, sf).select("intervention_id", "machine_id", "cout_eur"), path)
    return io.read_table(spark, path)


@query
def sink_csv_export_roundtrip(spark, sf):
    path = scratch.scratch_path(spark, "sink_csv")
    costs = _costs(spark, sf)
    io.export_csv(costs, path)
    return io.read_csv(spark, path, costs.schema)


@query
def preview_limit(spark, sf):
    return io.preview(tables.maintenance(spark, sf).select("machine_id", "intervention_id", "cout_eur"),
                      ["machine_id", "intervention_id", "cout_eur"], 10)


# Projections


@query
def add_lineage(spark, sf):
    feed = cleaning.add_lineage(tables.scada(spark, sf).drop("_row_id"), "scada_logs.json", "SCADA")
    return feed.select(
        "event_id",
        "code_alarme",
        "_source_file",
        "_source_system",
        F.col("_ingestion_timestamp").isNotNull().alias("has_time"),
        (F.col("_row_id") >= 0).alias("has_id"),
    )


@query
def cast_coerce(spark, sf):
    raw = tables.sensors(spark, sf)
    return raw.select(
        "_row_id",
        numeric.to_number(F.substring("timestamp", 1, 4)).alias("head_number"),
        F.col("_row_id").cast("string").alias("row_text"),
        F.col("temperature_c").isNull().cast("int").alias("missing"),
        F.lit(None).cast("double").alias("nothing"),
    )


@query
def quality_label(spark, sf):
    return _sensors(spark, sf).select("_row_id", "anomalie_detectee", "any_was_null", "qualite_donnee")


@query
def order_status(spark, sf):
    return _mes(spark, sf).select("ordre_id", "machine_id", "date_fin_reelle_clean", "ordre_statut")


@query
def order_delay_hours(spark, sf):
    return _mes(spark, sf).select("ordre_id", "date_fin_prevue_clean", "date_fin_reelle_clean", "retard_heures")


@query
def yield_pct(spark, sf):
    return _mes(spark, sf).select("ordre_id", "quantite_prevue", "quantite_produite", "taux_rendement_pct")


@query
def clamp_expr(spark, sf):
    return tables.sensors(spark, sf).select(
        "_row_id",
        numeric.clamp("temperature_c", 0.0, 100.0).alias("bounded"),
        numeric.clamp(numeric.ratio("temperature_c", F.floor("pression_bar")), 0.0, 1.0).alias("bounded_ratio"),
        F.abs("temperature_c").alias("size"),
    )


@query
def threshold_status(spark, sf):
    return dashboards.oee_targets(_oee(spark, sf), KPI)


# Predicates and NULL handling


@query
def anomaly_flags(spark, sf):
    rules = [rule.flag for rule in SETTINGS.range_rules]
    return _flagged(spark, sf).select("_row_id", *rules, "anomalie_detectee")


@query
def filter_anomalies(spark, sf):
    kept = _flagged(spark, sf).filter("anomalie_detectee")
    return kept.select("_row_id", "temperature_c", "vibration_mms", "pression_bar")


@query
def anomaly_flags_two_valued(spark, sf):
    rules = SETTINGS.range_rules[:2]
    return tables.sensors(spark, sf).select("_row_id", cleaning.anomaly_known(rules).alias("anomalie_detectee"))


@query
def fill_defaults(spark, sf):
    days = gold.join_daily(gold.daily_sensors(_sensors(spark, sf), KPI), gold.daily_states(_scada(spark, sf), KPI))
    filled = cleaning.fill_defaults(days, {"nb_alarmes": 0, "duree_arret_minutes": 0.0})
    return filled.select("date", "machine_id", "nb_alarmes", "duree_arret_minutes")


@query
def dropna_subset(spark, sf):
    complete = tables.sensors(spark, sf).dropna(subset=["temperature_c", "vibration_mms"])
    return complete.select("_row_id", "temperature_c", "vibration_mms", "pression_bar")


@query
def filter_between(spark, sf):
    return tables.sensors(spark, sf).filter(F.col("temperature_c").between(-10, 130)).select("_row_id", "temperature_c")


# Joins


def _states_near_readings(spark, sf, strategy, limits=SizeLimits()):
    """Both sides are written first, as the silver layer does, so counting them is a scan."""
    readings = _unique(spark, sf).select("_row_id", "machine_id", "timestamp_clean", "temperature_c")
    states = _scada(spark, sf).select("machine_id", F.col("timestamp_clean").alias("scada_ts"), "event_id", "code_alarme")
    return joins.range_join(
        scratch.stage(readings, "readings"),
        scratch.stage(states, "states"),
        by=["machine_id"],
        left_ts="timestamp_clean",
        right_ts="scada_ts",
        tolerance_s=300,
        left_id="_row_id",
        right_id="event_id",
        strategy=strategy,
        limits=limits,
    )


@query
def range_join_left(spark, sf):
    return _states_near_readings(spark, sf, "auto")


@query
def range_join_naive(spark, sf):
    return _states_near_readings(spark, sf, "naive")


@query
def range_join_salted(spark, sf):
    """Every slot with two rows of a side is cut."""
    return _states_near_readings(spark, sf, "salted", SizeLimits(max_slot_rows=1))


@query
def left_join_daily(spark, sf):
    return gold.join_daily(gold.daily_sensors(_sensors(spark, sf), KPI), gold.daily_states(_scada(spark, sf), KPI))


@query
def left_join_chain_weekly(spark, sf):
    return gold.join_weekly(
        gold.weekly_sensors(_sensors(spark, sf)),
        gold.weekly_downtime(_scada(spark, sf), KPI),
        gold.weekly_production(_mes(spark, sf), KPI),
    )


# Aggregations


@query
def dedup_keep_first(spark, sf):
    return _unique(spark, sf).select("_row_id", "machine_id", "timestamp", "temperature_c", "pression_bar")


@query
def dedup_three_keys(spark, sf):
    states = cleaning.keep_first(tables.scada(spark, sf), ["machine_id", "timestamp", "etat"], ["_row_id"])
    return states.select("_row_id", "event_id", "machine_id", "timestamp", "etat", "code_alarme")


@query
def category_counts(spark, sf):
    """The three feeds have no label in common."""
    labels = _sensors(spark, sf).select(F.col("qualite_donnee").alias("label"))
    labels = labels.union(_scada(spark, sf).select("etat")).union(_mes(spark, sf).select("ordre_statut"))
    return aggregates.category_counts(labels, "label", "n")


@query
def daily_sensor_agg(spark, sf):
    return gold.daily_sensors(_sensors(spark, sf), KPI)


@query
def daily_state_agg(spark, sf):
    return gold.daily_states(_scada(spark, sf), KPI)


@query
def weekly_count(spark, sf):
    return gold.weekly_sensors(_sensors(spark, sf))


@query
def weekly_downtime(spark, sf):
    return gold.weekly_downtime(_scada(spark, sf), KPI)


@query
def weekly_production(spark, sf):
    return gold.weekly_production(_mes(spark, sf), KPI)


@query
def quality_report(spark, sf):
    return dashboards.quality_report(tables.sensors(spark, sf), _sensors(spark, sf))


@query
def pivot_alarms(spark, sf):
    alarms = _scada(spark, sf).filter("etat = 'ALARME'")
    daily = alarms.groupBy(F.to_date("timestamp_clean").alias("date"), "code_alarme").agg(
        F.count(F.lit(1)).alias("nb_alarmes")
    )
    return dashboards.alarm_table(daily, "code_alarme", ALARM_CODES)


@query
def pivot_alarms_by_machine(spark, sf):
    return dashboards.alarm_table(_kpis(spark, sf))


@query
def pivot_oee(spark, sf):
    return dashboards.oee_heatmap(_oee(spark, sf), kpi=KPI)


@query
def oee_components_by_machine(spark, sf):
    return dashboards.oee_components(_oee(spark, sf), KPI)


@query
def argmax_per_group(spark, sf):
    return dashboards.hottest_day(_kpis(spark, sf))


@query
def distinct_keys(spark, sf):
    return tables.sensors(spark, sf).select("machine_id").distinct()


@query
def run_summary(spark, sf):
    feeds = [make(spark, sf) for make in (tables.sensors, tables.scada, tables.mes, tables.maintenance)]
    return dashboards.run_summary(*feeds, _oee(spark, sf), _costs(spark, sf), SETTINGS)


@query
def cost_split(spark, sf):
    return dashboards.cost_split(_costs(spark, sf), KPI)


@query
def distribution_by_group(spark, sf):
    return dashboards.temperature_quartiles(tables.sensors(spark, sf), KPI)


@query
def distribution_by_group_chunked(spark, sf):
    return dashboards.temperature_quartiles(tables.sensors(spark, sf), KPI, "chunked", SMALL_CHUNKS)


@query
def distribution_by_group_hot(spark, sf):
    """The hot machine's readings are counted in ranges, never sorted."""
    return dashboards.temperature_quartiles(tables.hot_sensors(spark, sf), KPI, "auto", HOT_LIMITS)


@query
def distribution_by_group_selected(spark, sf):
    return dashboards.temperature_quartiles(tables.sensors(spark, sf), KPI, "selected")


@query
def histogram_by_group(spark, sf):
    return dashboards.temperature_histogram(tables.sensors(spark, sf), 5.0, KPI)


@query
def sample_bounded(spark, sf):
    return dashboards.anomaly_points(tables.sensors(spark, sf), "_row_id", SETTINGS.range_rules[:2], KPI)


# Ordered operators


def _fill(spark, sf, strategy, limits):
    rows = ordered.order_rows(
        _unique(spark, sf), ["machine_id"], ["timestamp_clean", "_row_id"], strategy, limits
    )
    names = SETTINGS.filled_columns
    filled = ordered.forward_fill(rows, {name: column for column, name in names.items()})
    return filled.select(
        "_row_id", *names.values(), *[cleaning.was_null(c, n).alias(f"{c}_was_null") for c, n in names.items()]
    )


@query
def forward_fill(spark, sf):
    return _fill(spark, sf, "auto", SizeLimits())


@query
def forward_fill_two_level(spark, sf):
    return _fill(spark, sf, "chunked", SMALL_CHUNKS)


@query
def state_duration(spark, sf):
    return _scada(spark, sf).select("event_id", "timestamp_clean", "next_timestamp", "duree_etat_minutes")


@query
def state_duration_chunked(spark, sf):
    settings = replace(SETTINGS, limits=SMALL_CHUNKS)
    states = silver.silver_scada(tables.scada(spark, sf), settings, "chunked")
    return states.select("event_id", "timestamp_clean", "next_timestamp", "duree_etat_minutes")


# Sorting


@query
def series_sorted(spark, sf):
    columns = ["temp_moyenne", "vibration_moyenne", "taux_disponibilite_pct"]
    return dashboards.series(_kpis(spark, sf), "date", columns)


@query
def mtbf_ranking(spark, sf):
    return dashboards.mtbf_ranking(_costs(spark, sf), KPI)


# Scalar functions


@query
def parse_mixed_timestamps(spark, sf):
    return _parsed(spark, sf).select("_row_id", "timestamp", "timestamp_clean")


@query
def parse_mixed_timestamps_exact(spark, sf):
    return tables.sensors(spark, sf).select(
        "_row_id", "timestamp", timestamps.parse_timestamp("timestamp", prefix=False).alias("timestamp_clean")
    )


@query
def parse_mixed_timestamps_legacy(spark, sf):
    """Any text that begins with a layout, to the minute where the shorter one is listed first."""
    return tables.sensors(spark, sf).select(
        "_row_id", "timestamp", timestamps.parse_timestamp("timestamp", prefix=True).alias("timestamp_clean")
    )


@query
def date_parts(spark, sf):
    started = F.col("date_debut_clean")
    return _mes(spark, sf).select(
        "ordre_id",
        F.to_date(started).alias("jour"),
        F.weekofyear(started).alias("semaine"),
        F.month(started).alias("mois"),
    )


@query
def date_format_label(spark, sf):
    labelled = _parsed(spark, sf).select("_row_id", timestamps.date_label("timestamp_clean").alias("label"))
    return labelled.withColumn("jour", timestamps.label_date("label"))


@query
def normalize_code(spark, sf):
    return tables.scada(spark, sf).select("_row_id", F.upper("code_alarme").alias("code_alarme"))


# Jobs


@query
def bronze_ingest(spark, sf):
    raw_dir = write_feeds(spark, sf)
    stored = []
    for source in bronze.SOURCES:
        path = scratch.scratch_path(spark, f"bronze_{source.table}")
        bronze.write_bronze(bronze.ingest(spark, source, raw_dir), path)
        feed = io.read_table(spark, path)
        filled = sum((F.col(name).isNotNull().cast("long") for name in source.schema.fieldNames()), F.lit(0))
        stored.append(
            feed.groupBy("_source_system", "_source_file").agg(
                F.count("_row_id").alias("n_rows"),
                F.sum(filled).alias("n_values"),
                F.min("machine_id").alias("first_machine"),
                F.max("machine_id").alias("last_machine"),
            )
        )
    return stored[0].union(stored[1]).union(stored[2]).union(stored[3])


def _bronze_values(spark, sf, table):
    """One feed through raw file and bronze table, every column of it."""
    (source,) = (s for s in bronze.SOURCES if s.table == table)
    path = scratch.scratch_path(spark, f"bronze_{table}")
    bronze.write_bronze(bronze.ingest(spark, source, write_feeds(spark, sf)), path)
    return io.read_table(spark, path).select(*source.schema.names)


def _with_bad_rows(spark, sf):
    """The sensors feed and the state events as lines, each with records that can't be read as declared."""
    folder = scratch.scratch_path(spark, "bad_rows")
    sensors = tables.sensors(spark, sf)
    spoilt = F.when(F.col("_row_id") % 50 == 1, F.lit("n.c.")).otherwise(F.col("temperature_c").cast("string"))
    io.export_csv(sensors.withColumn("temperature_c", spoilt).drop("_row_id"), f"{folder}/sensors_data.csv")
    events = tables.scada(spark, sf)
    line = F.to_json(F.struct(*[c for c in events.columns if c != "_row_id"]))
    cut = F.when(F.col("_row_id") % 40 == 0, F.expr("substring(line, 1, length(line) - 5)")).otherwise(F.col("line"))
    events.withColumn("line", line).select(cut.alias("value")).write.text(f"{folder}/scada_logs.json")
    return folder


def _stored(spark, folder, keep_bad):
    """(source, bronze table, bad records, counts) of both feeds."""
    for source in bronze.sources(scada_lines=True)[:2]:
        path, bad = (scratch.scratch_path(spark, f"{source.table}_{name}") for name in ("bronze", "bad"))
        counts = bronze.store_feed(bronze.read_feed(spark, source, folder), path, bad, keep_bad=keep_bad)
        yield source, io.read_table(spark, path), io.read_table(spark, bad), counts


@query
def bronze_bad_rows(spark, sf):
    """Per feed the records that can't be read as declared: counted while writing, and as they are kept."""
    parts, marks = [], {"sensors": ",n.c.,", "scada": '{"event_id":"EVT_'}
    for source, kept, bad, counts in _stored(spark, _with_bad_rows(spark, sf), keep_bad=False):
        found = bad.agg(
            F.count(F.lit(1)).alias("n_bad"),
            F.count("machine_id").alias("n_readable"),
            F.count(F.when(F.col(io.BAD_RECORD).contains(marks[source.table]), 1)).alias("n_texts"),
        )
        bronze_rows = kept.agg(F.count(F.lit(1)).alias("n_rows"))
        one = aggregates.side_by_side(found, bronze_rows)
        parts.append(
            one.withColumns(
                {
                    "source": F.lit(source.table),
                    "counted_rows": F.lit(counts["rows"]).cast("long"),
                    "counted_bad": F.lit(counts["bad"]).cast("long"),
                }
            )
        )
    return parts[0].unionByName(parts[1])


@query
def bronze_keeps_bad_rows(spark, sf):
    """Both feeds whole in bronze: what can't be read is NULL."""
    stored = [kept for _, kept, _, _ in _stored(spark, _with_bad_rows(spark, sf), keep_bad=True)]
    return stored[0].select("timestamp", "machine_id", "temperature_c", F.lit(None).cast("string").alias("event_id")).unionByName(
        stored[1].select("timestamp", "machine_id", F.lit(None).cast("double").alias("temperature_c"), "event_id")
    )


@query
def bronze_sensors(spark, sf):
    return _bronze_values(spark, sf, "sensors")


@query
def bronze_scada(spark, sf):
    return _bronze_values(spark, sf, "scada")


@query
def bronze_mes(spark, sf):
    return _bronze_values(spark, sf, "mes")


@query
def bronze_maintenance(spark, sf):
    return _bronze_values(spark, sf, "maintenance")


@query
def silver_sensors_from_part_files(spark, sf):
    """Part files of unequal size; copies come in the last one, after the readings they repeat."""
    folder, path = (scratch.scratch_path(spark, f"part_files_{name}") for name in ("raw", "bronze"))
    row = F.col("_row_id")
    piece = F.when(row % 2 == 1, F.lit(64)).otherwise(F.floor(F.log2(row + 1)))
    parts = tables.sensors(spark, sf).withColumn("_piece", piece).repartitionByRange(8, "_piece")
    io.export_csv(parts.sortWithinPartitions("_piece", "_row_id").drop("_piece", "_row_id"), f"{folder}/sensors_data.csv")
    (source,) = (s for s in bronze.SOURCES if s.table == "sensors")
    bronze.write_bronze(bronze.ingest(spark, source, folder), path)
    return silver.silver_sensors(io.read_table(spark, path), SETTINGS).drop(*tables.LINEAGE)


@query
def silver_sensors(spark, sf):
    return _sensors(spark, sf)


@query
def silver_sensors_chunked(spark, sf):
    return silver.silver_sensors(tables.sensors(spark, sf), replace(SETTINGS, limits=SMALL_CHUNKS), "chunked")


@query
def silver_sensors_hot(spark, sf):
    """A third of all readings come from one machine: it is cut into chunks, the others are walked whole."""
    return silver.silver_sensors(tables.hot_sensors(spark, sf), replace(SETTINGS, limits=HOT_LIMITS))


@query
def silver_sensors_hot_window(spark, sf):
    """The same feed with a task per machine."""
    return silver.silver_sensors(tables.hot_sensors(spark, sf), SETTINGS, "window")


@query
def silver_scada(spark, sf):
    return _scada(spark, sf)


@query
def silver_days_rewritten(spark, sf):
    """Silver by day; the days from 10 January 2024 on are written again with their alarms only."""
    path = scratch.scratch_path(spark, "silver_days")
    states = scratch.stage(_scada(spark, sf), "states")
    io.write_days(states, path, "timestamp_clean")
    again = states.where("etat = 'ALARME' AND timestamp_clean >= TIMESTAMP '2024-01-10 00:00:00'")
    io.write_days(again, path, "timestamp_clean")
    return io.read_days(spark, path).select("event_id", "jour", "etat", "timestamp_clean")


@query
def gold_kpis_of_two_days(spark, sf):
    """Gold from the files of two days alone."""
    paths = [scratch.scratch_path(spark, f"days_{name}") for name in ("sensors", "scada")]
    for path, frame in zip(paths, (_sensors(spark, sf), _scada(spark, sf))):
        io.write_days(frame, path, "timestamp_clean")
    sensors, states = (io.read_days(spark, path, date(2024, 1, 5), date(2024, 1, 6)) for path in paths)
    return gold.gold_kpis_machines(sensors, states, KPI)


def bucketed_silver(spark, sf, buckets=8):
    """Sensors and states in buckets by machine."""
    names = []
    for name, frame in (("sensors", _sensors(spark, sf)), ("scada", _scada(spark, sf))):
        path = scratch.scratch_path(spark, f"buckets_{name}")
        names.append("t_" + path.rsplit("-", 1)[1])
        io.write_bucketed(frame, names[-1], path, "machine_id", buckets)
    return [spark.table(name) for name in names]


@query
def gold_kpis_bucketed(spark, sf):
    return gold.gold_kpis_machines(*bucketed_silver(spark, sf), KPI)


@query
def silver_mes(spark, sf):
    return _mes(spark, sf)


@query
def silver_maintenance(spark, sf):
    return silver.silver_maintenance(tables.maintenance(spark, sf))


@query
def sensors_enriched(spark, sf):
    sensors, scada = scratch.stage(_sensors(spark, sf), "sensors"), scratch.stage(_scada(spark, sf), "scada")
    return silver.sensors_enriched(sensors, scada, SETTINGS)


@query
def gold_kpis_machines(spark, sf):
    return _kpis(spark, sf)


@query
def gold_oee(spark, sf):
    return _oee(spark, sf)


@query
def gold_maintenance_cost(spark, sf):
    return _costs(spark, sf)


@query
def gold_production_summary(spark, sf):
    return gold.gold_production_summary(_mes(spark, sf), KPI)


def write_feeds(spark, sf):
    """The four feeds as raw files, as the plant would deliver them: compressed part files of bounded size."""
    raw_dir = scratch.scratch_path(spark, "raw")
    io.export_csv(tables.sensors(spark, sf).drop("_row_id"), f"{raw_dir}/sensors_data.csv", **PART_FILES)
    tables.write_json_arrays(tables.scada(spark, sf).drop("_row_id"), f"{raw_dir}/scada_logs.json", "gzip")
    io.export_csv(tables.mes(spark, sf), f"{raw_dir}/mes_orders.csv", **PART_FILES)
    io.export_csv(tables.maintenance(spark, sf), f"{raw_dir}/maintenance_logs.csv", **PART_FILES)
    return raw_dir


@query
def medallion_run(spark, sf):
    _, report = _all_layers(spark, sf)
    return report.select("stage", "table", "rows", "status")


def _all_layers(spark, sf):
    layout = run.Layout(write_feeds(spark, sf), scratch.scratch_path(spark, "layers"))
    return layout, run.run_layers(spark, layout, SETTINGS)


@query
def medallion_resume(spark, sf):
    """A run that breaks in gold, since a file is in the place of its folder, and is taken up again."""
    layout = run.Layout(write_feeds(spark, sf), scratch.scratch_path(spark, "layers"))
    blocked = f"{layout.base_dir}/gold"
    io.write_marker(spark, blocked, "")
    broken = run.run_layers(spark, layout, SETTINGS, workers=2).where("status LIKE 'FAILED%'").count()
    io.delete_marker(spark, blocked)
    report = run.run_layers(spark, layout, SETTINGS, workers=2, resume=True)
    return report.select("stage", "table", "rows", "status", (F.lit(broken) > 0).alias("broke_before"))


@query
def charts_in_order(spark, sf):
    """Positions of three charts' rows, read from the tables that a run wrote."""
    layout, _ = _all_layers(spark, sf)
    parts = []
    for chart, label in (("sensor_series", "date"), ("oee_targets", "semaine"), ("mtbf_ranking", "mtbf_heures")):
        rows = io.read_table(spark, layout.table("dashboards", chart))
        place = F.col("position").cast("long").alias("position")
        parts.append(rows.select(F.lit(chart).alias("chart"), place, "machine_id", F.col(label).isNull().alias("unknown")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def medallion_gold_oee(spark, sf):
    layout, _ = _all_layers(spark, sf)
    return io.read_table(spark, layout.table("gold", "gold_oee"))


@query
def medallion_gold_kpis(spark, sf):
    layout, _ = _all_layers(spark, sf)
    return io.read_table(spark, layout.table("gold", "gold_kpis_machines"))
