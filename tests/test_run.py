import json
import os
from dataclasses import replace

import pytest

from checks import tables
from plantmetrics.__main__ import main
from plantmetrics.config import DEFAULTS, KpiSettings, SizeLimits
from plantmetrics.plans.run import Layout, run_layers
from plantmetrics.sources import export_csv, read_table, scratch, stage

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def raw_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    export_csv(tables.sensors(spark, SF).drop("_row_id"), f"{folder}/sensors_data.csv")
    export_csv(tables.mes(spark, SF), f"{folder}/mes_orders.csv")
    export_csv(tables.maintenance(spark, SF), f"{folder}/maintenance_logs.csv")
    events = [json.loads(line) for line in tables.scada(spark, SF).drop("_row_id").toJSON().collect()]
    with open(f"{folder}/scada_logs.json", "w", encoding="utf-8") as file:
        json.dump(events, file, indent=1)
    return folder


def test_all_layers(spark, raw_dir, tmp_path):
    settings = replace(DEFAULTS, kpi=KpiSettings(sum_scale=6))
    layout = Layout(raw_dir, str(tmp_path))
    report = {r.table: r for r in run_layers(spark, layout, settings).collect()}
    assert len(report) == 26 and {r.status for r in report.values()} == {"OK"}
    assert report["sensors"].rows == tables.sensors(spark, SF).count()
    assert report["sensors_silver"].rows < report["sensors"].rows
    assert report["sensors_enriched"].rows >= report["sensors_silver"].rows
    kpis = read_table(spark, layout.table("gold", "gold_kpis_machines"))
    assert kpis.agg({"nb_mesures": "sum"}).first()[0] == report["sensors_silver"].rows
    with open(f"{layout.csv('gold_oee')}/{next(f for f in os.listdir(layout.csv('gold_oee')) if f.endswith('.csv'))}") as file:
        assert file.readline().startswith("semaine,machine_id,nb_mesures_semaine,")


def test_staged_tables_go_with_their_job(spark, raw_dir, tmp_path):
    mine = stage(spark.range(3).toDF("n"), "mine")
    before = scratch.written(spark)
    limits = SizeLimits(max_group_rows=5, chunk_rows=50)
    report = run_layers(spark, Layout(raw_dir, str(tmp_path)), replace(DEFAULTS, limits=limits)).collect()
    assert {r.status for r in report} == {"OK"}
    assert scratch.written(spark) == before and mine.count() == 3


def test_first_failure_ends_the_run(spark, tmp_path):
    report = run_layers(spark, Layout(str(tmp_path / "nothing"), str(tmp_path))).collect()
    assert len(report) == 1 and report[0].status.startswith("FAILED") and report[0].rows is None


def test_command_line(spark, raw_dir, tmp_path, capsys):
    assert main([raw_dir, str(tmp_path / "out"), "--no-csv"]) == 0
    printed = capsys.readouterr().out.splitlines()
    assert len(printed) == 26 and all(line.endswith("OK") for line in printed)
    assert not os.path.exists(tmp_path / "out" / "gold" / "csv")
    assert main([str(tmp_path / "nothing"), str(tmp_path / "out2")]) == 1


def test_a_layer_that_can_not_be_written_is_not_computed(spark, raw_dir, tmp_path, monkeypatch):
    layout, built = Layout(raw_dir, str(tmp_path)), []
    for name in ("gold_kpis_machines", "gold_oee", "gold_maintenance_cost", "gold_production_summary"):
        monkeypatch.setattr(f"plantmetrics.plans.gold.{name}", lambda *frames, name=name: built.append(name) or frames[0])
    (tmp_path / "gold").write_text("in the way")
    broken = {r.table: (r.stage, r.status) for r in run_layers(spark, layout, workers=2).collect()}
    assert built == []
    failed = {stage for stage, status in broken.values() if status != "OK"}
    assert failed == {"gold"} and all(status.startswith("FAILED") for stage, status in broken.values() if stage == "gold")
    # whatever is slow, the layers before are whole
    assert sum(stage in ("bronze", "silver") for stage, _ in broken.values()) == 9


def test_a_broken_run_is_taken_up(spark, raw_dir, tmp_path):
    layout, settings = Layout(raw_dir, str(tmp_path)), replace(DEFAULTS, kpi=KpiSettings(sum_scale=6))
    (tmp_path / "dashboards").write_text("in the way")
    broken = {r.table: r.status for r in run_layers(spark, layout, settings, workers=3).collect()}
    assert any(status.startswith("FAILED") for status in broken.values()) and "run_summary" not in broken
    whole = {table for table, status in broken.items() if status == "OK"}
    assert "gold_kpis_machines" in whole
    (tmp_path / "dashboards").unlink()
    again = {r.table: r for r in run_layers(spark, layout, settings, workers=3, resume=True).collect()}
    assert len(again) == 26
    assert {table for table, row in again.items() if row.status == "KEPT"} == whole
    assert {row.status for table, row in again.items() if table not in whole} == {"OK"}
    assert again["sensors"].rows == tables.sensors(spark, SF).count() and again["sensors"].bad_rows == 0
    placed = read_table(spark, layout.table("dashboards", "oee_targets")).orderBy("position").collect()
    assert [r.position for r in placed] == list(range(1, len(placed) + 1))
    assert [(r.machine_id, r.semaine or 0) for r in placed] == sorted((r.machine_id, r.semaine or 0) for r in placed)
    # another setting, or another feed, makes anew what depends on it
    changed = replace(settings, kpi=replace(settings.kpi, oee_target_pct=50.0))
    assert {r.status for r in run_layers(spark, layout, changed, workers=3, resume=True).collect()} == {"OK"}
