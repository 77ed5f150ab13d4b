"""All layers on one session: layer by layer, each table as soon as those it reads are there, and none twice."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from plantmetrics import schemas
from plantmetrics.config import DEFAULTS, Settings
from plantmetrics.operators.ordered import with_position
from plantmetrics.plans import bronze, dashboards, gold, silver
from plantmetrics.sources.scratch import scratch_scope
from plantmetrics.sources.tables import (
    delete_marker,
    export_csv,
    make_folder,
    read_marker,
    read_table,
    write_counted,
    write_marker,
)


@dataclass(frozen=True)
class Layout:
    """Folders of the layers; ``raw_dir`` holds the four feeds. ``scada_lines``: state events come as JSON Lines.

    ``keep_bad_rows``: records that could not be read as declared stay in bronze, as far as they could be read.
    Their text is in ``bronze_bad`` either way.
    """

    raw_dir: str
    base_dir: str
    fmt: str = "parquet"
    export_gold_csv: bool = True
    scada_lines: bool = False
    keep_bad_rows: bool = True

    def table(self, layer: str, name: str) -> str:
        return f"{self.base_dir}/{layer}/{name}"

    def csv(self, name: str) -> str:
        return f"{self.base_dir}/gold/csv/{name}"

    def marker(self, layer: str, name: str) -> str:
        return f"{self.base_dir}/_done/{layer}.{name}.json"


@dataclass(frozen=True)
class Job:
    """One table: the tables it reads (``layer/name``) and how its frame is built, or written where not plainly."""

    stage: str
    table: str
    needs: tuple[str, ...]
    build: Callable[[], DataFrame]
    source: bronze.Source | None = None

    @property
    def name(self) -> str:
        return f"{self.stage}/{self.table}"


def _jobs(spark: SparkSession, layout: Layout, settings: Settings) -> list[Job]:
    """The tables, each after those it reads."""
    jobs: list[Job] = []

    def load(layer: str, name: str) -> DataFrame:
        return read_table(spark, layout.table(layer, name), layout.fmt)

    def job(stage: str, table: str, reads: Sequence[tuple[str, str]], build: Callable[..., DataFrame]) -> None:
        """``build`` takes the frames it reads in the order of ``reads``."""
        needs = tuple(f"{layer}/{name}" for layer, name in reads)
        jobs.append(Job(stage, table, needs, lambda: build(*(load(*one) for one in reads))))

    for source in bronze.sources(layout.scada_lines):
        feed = lambda source=source: bronze.read_feed(spark, source, layout.raw_dir, settings.limits)
        jobs.append(Job("bronze", source.table, (), feed, source))

    raw = {source.table: ("bronze", source.table) for source in bronze.SOURCES}
    sensors, scada, mes = ("silver", "sensors_silver"), ("silver", "scada_silver"), ("silver", "mes_silver")
    maintenance = ("silver", "maintenance_silver")
    job(*sensors, [raw["sensors"]], lambda df: silver.silver_sensors(df, settings))
    job(*scada, [raw["scada"]], lambda df: silver.silver_scada(df, settings))
    job(*mes, [raw["mes"]], lambda df: silver.silver_mes(df, settings))
    job(*maintenance, [raw["maintenance"]], silver.silver_maintenance)
    job("silver", "sensors_enriched", [sensors, scada], lambda a, b: silver.sensors_enriched(a, b, settings))

    kpi = settings.kpi
    days, weeks = ("gold", "gold_kpis_machines"), ("gold", "gold_oee")
    costs = ("gold", "gold_maintenance_cost")
    job(*days, [sensors, scada], lambda a, b: gold.gold_kpis_machines(a, b, kpi))
    job(*weeks, [sensors, scada, mes], lambda a, b, c: gold.gold_oee(a, b, c, kpi))
    job(*costs, [maintenance], lambda df: gold.gold_maintenance_cost(df, kpi))
    job("gold", "gold_production_summary", [mes], lambda df: gold.gold_production_summary(df, kpi))

    for table, (reads, build) in _dashboards(settings, sensors, raw["sensors"], days, weeks, costs).items():
        job("dashboards", table, reads, build)
    summed = [*(raw[source.table] for source in bronze.SOURCES), weeks, costs]
    job("summary", "run_summary", summed, lambda *frames: dashboards.run_summary(*frames, settings))
    return jobs


def _dashboards(settings: Settings, sensors, raw_sensors, days, weeks, costs) -> dict[str, tuple[list, Callable[..., DataFrame]]]:
    """The tables behind the charts: what each reads, and how it is built from that. Charts drawn in an order keep
    it as a column, since a written table has none.
    """
    kpi, plotted = settings.kpi, ("temperature_c", "vibration_mms")
    rules = [rule for rule in settings.range_rules if rule.column in plotted]
    measures = ["temp_moyenne", "vibration_moyenne", "taux_disponibilite_pct"]
    limits = settings.limits

    def placed(df: DataFrame, *order: str) -> DataFrame:
        return with_position(df, order, limits=limits)

    return {
        "sensor_series": ([days], lambda df: placed(dashboards.series(df, "date", measures), "machine_id", "date")),
        "hottest_day": ([days], dashboards.hottest_day),
        "alarm_table": ([days], dashboards.alarm_table),
        "oee_heatmap": ([weeks], lambda df: dashboards.oee_heatmap(df, kpi=kpi)),
        "oee_components": ([weeks], lambda df: dashboards.oee_components(df, kpi)),
        "oee_targets": ([weeks], lambda df: placed(dashboards.oee_targets(df, kpi), "machine_id", "semaine")),
        "anomaly_points": ([sensors], lambda df: dashboards.anomaly_points(df, silver.ROW_ID, rules, kpi)),
        "temperature_quartiles": ([sensors], lambda df: dashboards.temperature_quartiles(df, kpi, limits=limits)),
        "temperature_histogram": ([sensors], lambda df: dashboards.temperature_histogram(df, kpi=kpi)),
        "cost_split": ([costs], lambda df: dashboards.cost_split(df, kpi)),
        "mtbf_ranking": ([costs], lambda df: placed(dashboards.mtbf_ranking(df, kpi), "mtbf_heures", "machine_id")),
        "quality_report": ([raw_sensors, sensors], dashboards.quality_report),
    }


def _fingerprints(spark: SparkSession, layout: Layout, settings: Settings, jobs: Sequence[Job]) -> dict[str, str]:
    """What each table depends on, as a digest: settings, the feed's files, and the tables it reads."""
    prints: dict[str, str] = {}
    for one in jobs:
        about = [one.name, repr(settings), layout.fmt, str(layout.keep_bad_rows), *(prints[need] for need in one.needs)]
        if one.source:
            about += [str(layout.scada_lines), str(bronze.feed_files(spark, f"{layout.raw_dir}/{one.source.file}"))]
        prints[one.name] = hashlib.sha256("\n".join(about).encode()).hexdigest()
    return prints


def _run_job(spark: SparkSession, layout: Layout, job: Job, pool: str, done: str | None) -> tuple:
    """Write one table; its row of the report. ``done`` goes into the marker that says the table is whole."""
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
    start, path = time.monotonic(), layout.table(job.stage, job.table)
    marker = layout.marker(job.stage, job.table)
    try:
        with scratch_scope(spark):
            delete_marker(spark, marker)
            make_folder(spark, f"{layout.base_dir}/{job.stage}")
            frame = job.build()
            if job.source:
                bad_path = layout.table("bronze_bad", job.table)
                found = bronze.store_feed(frame, path, bad_path, layout.fmt, layout.keep_bad_rows, job.source.system)
            else:
                found = write_counted(frame, path, layout.fmt)
            if job.stage == "gold" and layout.export_gold_csv:
                export_csv(read_table(spark, path, layout.fmt), layout.csv(job.table))
        rows, bad = found["rows"], found.get("bad")
        if done:
            write_marker(spark, marker, json.dumps({"of": done, "rows": rows, "bad": bad}))
        return job.stage, job.table, rows, time.monotonic() - start, "OK", bad
    except Exception as error:
        return job.stage, job.table, None, time.monotonic() - start, f"FAILED: {error}", None


def run_layers(
    spark: SparkSession, layout: Layout, settings: Settings = DEFAULTS, *, workers: int = 1, resume: bool = False
) -> DataFrame:
    """Build every table and report rows, seconds, status and, for feeds, records that could not be read as declared.

    Up to ``workers`` tables are written at the same time, each in a scheduler pool of its own, as soon as the tables
    they read are there and all of the layers before have been begun. After a failure nothing new is begun; a layer whose
    folder can't be made fails before its tables are computed. Rows are counted as they are written.

    A table gets a marker once it is whole, with a digest of what it was made from: settings, the names, sizes and
    times of the feed's files, and the digests of the tables it reads. With ``resume``, tables whose marker still
    fits stay as they are (status ``KEPT``), so a run that broke is taken up where it stopped.

    What a table's plan staged on the way is deleted once the table is written.
    """
    jobs = _jobs(spark, layout, settings)
    report: dict[str, tuple] = {}
    prints: dict[str, str] = {}
    try:
        prints = _fingerprints(spark, layout, settings, jobs)
    except Exception as error:
        first = jobs[0]
        report[first.name] = (first.stage, first.table, None, 0.0, f"FAILED: {error}", None)
    waiting = [] if report else list(jobs)
    if resume:
        for one in jobs:
            known = json.loads(read_marker(spark, layout.marker(one.stage, one.table)) or "{}")
            if known.get("of") == prints.get(one.name, ""):
                report[one.name] = (one.stage, one.table, known["rows"], 0.0, "KEPT", known["bad"])
                waiting.remove(one)
    running: dict[Future, Job] = {}
    with ThreadPoolExecutor(max_workers=workers) as pool:
        while waiting or running:
            # of the first layer that has tables not begun, so that a failure leaves no gap in the layers before its own
            ready = [one for one in waiting if one.stage == waiting[0].stage and all(need in report for need in one.needs)]
            for one in ready[: workers - len(running)]:
                waiting.remove(one)
                running[pool.submit(_run_job, spark, layout, one, one.table, prints[one.name])] = one
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                row = future.result()
                report[running.pop(future).name] = row
                if row[4].startswith("FAILED"):
                    waiting = []
    ordered = [report[one.name] for one in jobs if one.name in report]
    return spark.createDataFrame(ordered, schemas.STAGE_REPORT)
