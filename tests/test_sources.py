import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks import tables
from plantmetrics import schemas
from plantmetrics.config import SizeLimits
from plantmetrics.operators.cleaning import keep_first
from plantmetrics.plans import bronze
from plantmetrics.sources import (
    clear_scratch,
    export_csv,
    preview,
    read_csv,
    read_days,
    read_json,
    read_table,
    scratch_path,
    scratch_scope,
    stage,
    write_bucketed,
    write_counted,
    write_days,
    write_table,
)
from plantmetrics.sources.tables import BAD_RECORD


def test_csv_with_declared_types_keeps_bad_rows(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        "timestamp,machine_id,temperature_c,vibration_mms,pression_bar,courant_a,statut_capteur\n"
        '2024-01-01T00:00:00,M1,1.5,,2,3,"OK, ""sure"""\n'
        "31/01/2024 23:55,M2,oops,1,2,3,OK\n"
    )
    rows = read_csv(spark, str(tmp_path / "f.csv"), schemas.SENSORS).collect()
    assert rows[0].statut_capteur == 'OK, "sure"' and rows[0].vibration_mms is None
    assert rows[1].temperature_c is None and rows[1].machine_id == "M2"
    inferred = read_csv(spark, str(tmp_path / "f.csv"))
    assert dict(inferred.dtypes)["courant_a"] == "int"


def test_json_array_and_lines(spark, tmp_path):
    events = [{"event_id": "E1", "etat": "ARRET", "machine_id": "M1"}, {"event_id": "E2", "code_alarme": "é"}]
    (tmp_path / "a.json").write_text(json.dumps(events, indent=1, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "l.json").write_text("\n".join(json.dumps(e) for e in events), encoding="utf-8")
    array = read_json(spark, str(tmp_path / "a.json"), schemas.SCADA)
    lines = read_json(spark, str(tmp_path / "l.json"), schemas.SCADA, lines=True)
    assert array.schema == schemas.SCADA and array.count() == 2
    assert array.exceptAll(lines).count() == 0
    assert "etat" in read_json(spark, str(tmp_path / "a.json")).columns


def test_json_of_the_other_form_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"event_id": "E1"},\n {"event_id": "E2"}]')
    (tmp_path / "l.json").write_text('{"event_id": "E1"}\n{"event_id": "E2"}\n')
    for name, lines in (("a.json", True), ("l.json", False)):
        with pytest.raises(Exception, match=name):
            read_json(spark, str(tmp_path / name), schemas.SCADA, lines=lines).count()


def test_json_array_with_more_behind_it_is_an_error(spark, tmp_path):
    whole = '[{"event_id": "E1", "description": "a ] [ b \\" ] {"}, {"event_id": "E2", "etat": "]"}]'
    broken = {
        "two": whole + '\n[{"event_id": "E3"}]',
        "object": whole + '{"event_id": "E3"}',
        "word": whole + " x",
        "cut": whole[:-8],
        "plain": "[1, 2]",
    }
    for name, text in {"whole": whole, "spaced": f"\n {whole} \n", "empty": "[]", "blank": " \n"}.items():
        (tmp_path / f"{name}.json").write_text(text)
        assert read_json(spark, str(tmp_path / f"{name}.json"), schemas.SCADA).count() == (2 if whole in text else 0)
    for name, text in broken.items():
        (tmp_path / f"{name}.json").write_text(text)
        with pytest.raises(Exception, match=f"{name}.json"):
            read_json(spark, str(tmp_path / f"{name}.json"), schemas.SCADA).collect()


def test_bad_lines_are_rows_with_their_text(spark, tmp_path):
    good, two = '{"event_id": "E1", "etat": "a} b"}', '{"event_id": "E2"} {"event_id": "E3"}'
    (tmp_path / "l.json").write_text(f'{good}\n\n{good[:-3]}\n{two}\nhello\n')
    rows = read_json(spark, str(tmp_path / "l.json"), schemas.SCADA, lines=True, bad_record="bad").collect()
    assert [(r.event_id, r.bad) for r in rows][:1] == [("E1", None)] and len(rows) == 4
    assert [r.bad for r in rows[1:]] == [good[:-3], two, "hello"]
    assert read_json(spark, str(tmp_path / "l.json"), schemas.SCADA, lines=True).count() == 4


HEADER = "timestamp,machine_id,temperature_c,vibration_mms,pression_bar,courant_a,statut_capteur\n"


def test_bad_csv_records_are_kept_and_counted(spark, tmp_path):
    lines = ["2024-01-01T00:00:00,M1,1.5,1,2,3,OK", "2024-01-01T00:00:01,M1,oops,1,2,3,OK", "2024-01-01T00:00:02,M2,1", "x,M3,1,1,1,1,OK,9"]
    (tmp_path / "sensors_data.csv").write_text(HEADER + "\n".join(lines) + "\n")
    feed = bronze.read_feed(spark, bronze.SOURCES[0], str(tmp_path))
    for keep, n in ((True, 4), (False, 1)):
        path, bad = str(tmp_path / f"b{keep}"), str(tmp_path / f"bad{keep}")
        assert bronze.store_feed(feed, path, bad, keep_bad=keep) == {"rows": n, "bad": 3}
        assert BAD_RECORD not in read_table(spark, path).columns and read_table(spark, path).count() == n
        kept = {r._bad_record: (r.machine_id, r.temperature_c) for r in read_table(spark, bad).collect()}
        assert kept == {lines[1]: ("M1", None), lines[2]: ("M2", 1.0), lines[3]: ("M3", 1.0)}
    (tmp_path / "sensors_data.csv").write_text(HEADER + lines[0] + "\n")
    again = bronze.store_feed(bronze.read_feed(spark, bronze.SOURCES[0], str(tmp_path)), path, bad)
    assert again == {"rows": 1, "bad": 0} and read_table(spark, bad).count() == 0


def test_rows_of_a_known_system_go_straight_to_its_folder(spark, tmp_path):
    """No sort by the system before the write; a feed without rows has a table as well, and what was there is gone."""
    source, path, bad = bronze.SOURCES[0], str(tmp_path / "b"), str(tmp_path / "bad")
    csv = tmp_path / "sensors_data.csv"
    for lines, old in ((["2024-01-01T00:00:00,M1,1.5,1,2,3,OK", "2024-01-01T00:00:01,M2,x,1,2,3,OK"], "OLD"), ([], "IOT")):
        write_table(spark.createDataFrame([(1, old)], "a int, _source_system string"), path, partition_by=["_source_system"])
        csv.write_text(HEADER + "".join(f"{line}\n" for line in lines))
        feed = bronze.read_feed(spark, source, str(tmp_path))
        found = bronze.store_feed(feed, path, bad, system=source.system)
        assert found == {"rows": len(lines), "bad": len(lines) // 2}
        assert os.listdir(path) == ["_source_system=IOT"]
        assert os.path.exists(f"{path}/_source_system=IOT/_SUCCESS")
        stored = read_table(spark, path)
        assert [r._source_system for r in stored.collect()] == ["IOT"] * len(lines)
        assert stored.columns == [*[c for c in feed.columns if c not in ("_source_system", BAD_RECORD)], "_source_system"]
    odd = "a b=c/é"
    write_table(spark.range(2).withColumn("s", F.lit(odd)), path, partition_by=["s"], constant={"s": odd})
    assert [r.s for r in read_table(spark, path).collect()] == [odd] * 2


def test_feed_is_scanned_once(spark, tmp_path):
    (tmp_path / "sensors_data.csv").write_text(HEADER + "2024-01-01T00:00:00,M1,1.5,1,2,3,OK\n")
    (tmp_path / "scada_logs.json").write_text('[{"event_id": "E1"}]')
    for source in bronze.SOURCES[:2]:
        plan = bronze.ingest(spark, source, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Window" not in plan and "hashpartitioning" not in plan


def test_row_ids_follow_files_and_pieces(spark, tmp_path):
    """Pieces of some 40 KB, read in any order."""
    folder = tmp_path / "sensors_data.csv"
    folder.mkdir()
    for k, n in enumerate((10, 4000, 0, 2500)):
        (folder / f"part-{k}.csv").write_text(HEADER + "".join(f"t{k}-{i:05},M1,1,1,1,1,OK\n" for i in range(n)))
    sizes = {"spark.sql.files.maxPartitionBytes": "40k", "spark.sql.files.openCostInBytes": "8k"}
    try:
        for key, value in sizes.items():
            spark.conf.set(key, value)
        rows = bronze.ingest(spark, bronze.SOURCES[0], str(tmp_path)).select("_row_id", "timestamp").collect()
    finally:
        for key in sizes:
            spark.conf.unset(key)
    assert len({r._row_id for r in rows}) == len(rows) == 6510
    assert [r.timestamp for r in sorted(rows)] == sorted(r.timestamp for r in rows)


def test_folders_of_any_name_and_files_that_come_late(spark, tmp_path):
    folder = tmp_path / "dossier été 100% #1"
    folder.mkdir()
    (folder / "sensors_data.csv").write_text(HEADER + "t0,M1,1,1,1,1,OK\n")
    (folder / "scada_logs.json").write_text('[{"event_id": "E1"}, {"event_id": "E2"}]')
    for source, n in zip(bronze.SOURCES[:2], (1, 2)):
        rows = bronze.ingest(spark, source, str(folder)).collect()
        assert len(rows) == n and all(r._row_id is not None for r in rows)
    late = tmp_path / "late" / "sensors_data.csv"
    late.mkdir(parents=True)
    (late / "a.csv").write_text(HEADER + "t0,M1,1,1,1,1,OK\n")
    rows = read_csv(spark, str(late), schemas.SENSORS)
    listed = bronze.feed_files
    try:
        bronze.feed_files = lambda *_: []
        with pytest.raises(Exception, match="came after the feed was listed"):
            bronze.feed_row_ids(spark, rows, str(late), 10).collect()
    finally:
        bronze.feed_files = listed


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(100, numPartitions=4).toDF("n").withColumn("odd", F.col("n") % 2)
    spark.sparkContext.setJobGroup("counted", "")
    found = write_counted(df, str(tmp_path / "t"), without="odd", odd=F.sum("odd"))
    spark.sparkContext.setJobGroup("other", "")
    assert found == {"rows": 100, "odd": 50} and read_table(spark, str(tmp_path / "t")).columns == ["n"]
    assert len(tracker.getJobIdsForGroup("counted")) == 1
    assert write_counted(df.limit(0), str(tmp_path / "e"), odd=F.sum("odd")) == {"rows": 0, "odd": 0}


def test_days_are_replaced_and_pruned(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.createDataFrame(
        [(datetime(2024, 1, d, 5), d) for d in range(1, 6)] + [(None, 9)], "timestamp_clean timestamp, v int"
    )
    write_days(rows, path, "timestamp_clean")
    write_days(rows.where("v IN (2, 9)").withColumn("v", F.col("v") * 100), path, "timestamp_clean")
    assert sorted(r.v for r in read_days(spark, path).collect()) == [1, 3, 4, 5, 200, 900]
    some = read_days(spark, path, date(2024, 1, 2), date(2024, 1, 3))
    assert sorted(r.v for r in some.collect()) == [3, 200]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(jour" in plan and "PushedFilters: []" in plan


def test_buckets_spare_the_shuffle_unless_a_machine_is_hot(spark, tmp_path, same_rows):
    rows = spark.range(400).select((F.col("id") % 13).alias("machine_id"), (F.col("id") % 7).alias("d"), F.col("id").alias("v"))
    for side in ("a", "b"):
        assert write_bucketed(rows, f"even_{side}", str(tmp_path / side), "machine_id", 4)
    assert not write_bucketed(rows, "hot_a", str(tmp_path / "h"), "machine_id", 4, SizeLimits(max_group_rows=20))
    parts = [spark.table(f"even_{s}").groupBy("machine_id", "d").agg(F.sum("v").alias(s)) for s in ("a", "b")]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        joined = parts[0].join(parts[1], ["machine_id", "d"], "left")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        plain = [rows.groupBy("machine_id", "d").agg(F.sum("v").alias(s)) for s in ("a", "b")]
        same_rows(plain[0].join(plain[1], ["machine_id", "d"], "left"), joined)
        same_rows(rows, spark.table("hot_a"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in ("even_a", "even_b", "hot_a"):
            spark.sql(f"DROP TABLE {name}")


def test_scopes_delete_only_what_they_staged(spark):
    outer = stage(spark.range(2).toDF("n"), "outer")
    with scratch_scope(spark):
        inner = scratch_path(spark, "inner")
        spark.range(1).write.parquet(inner)
    assert not os.path.exists(inner) and outer.count() == 2


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        "machine_id,extra,timestamp,vibration_mms,temperature_c,courant_a,pression_bar,statut_capteur\n"
        "M1,x,2024-01-01T00:00:00,1.5,60,3,4,OK\n"
    )
    row = read_csv(spark, str(tmp_path / "f.csv"), schemas.SENSORS).first()
    assert (row.machine_id, row.temperature_c, row.vibration_mms, row.courant_a) == ("M1", 60.0, 1.5, 3.0)
    (tmp_path / "g.csv").write_text("machine_id,timestamp\nM1,x\n")
    with pytest.raises(ValueError, match="vibration_mms"):
        read_csv(spark, str(tmp_path / "g.csv"), schemas.SENSORS)


def test_first_copy_of_part_files_stays(spark, tmp_path):
    """The later file is larger, so Spark reads it first."""
    folder = tmp_path / "sensors_data.csv"
    folder.mkdir()
    header = "timestamp,machine_id,temperature_c,vibration_mms,pression_bar,courant_a,statut_capteur\n"
    (folder / "part-0.csv").write_text(header + "2024-01-01T00:00:00,M1,1.0,1,1,1,OK\n")
    more = "".join(f"2024-01-01T00:{k // 60:02}:{k % 60:02},M2,5.0,1,1,1,OK\n" for k in range(3000))
    (folder / "part-1.csv").write_text(header + "2024-01-01T00:00:00,M1,999.0,1,1,1,OK\n" + more)
    path = str(tmp_path / "bronze")
    write_table(bronze.ingest(spark, bronze.SOURCES[0], str(tmp_path)), path)
    rows = read_table(spark, path)
    kept = keep_first(rows, ["machine_id", "timestamp"], ["_row_id"]).filter("machine_id = 'M1'")
    assert [r.temperature_c for r in kept.collect()] == [1.0]
    assert rows.select("_row_id").distinct().count() == rows.count() == 3002


def test_overwrite_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    write_table(spark.range(2).withColumn("x", F.lit("y")), path)
    again = read_table(spark, path)
    assert again.columns == ["id", "x"] and again.count() == 2


def test_bronze_table_is_partitioned_by_source(spark, tmp_path):
    path = str(tmp_path / "b")
    bronze.write_bronze(spark.range(3).withColumn("_source_system", F.lit("IOT")), path)
    assert "_source_system=IOT" in os.listdir(path)
    assert read_table(spark, path).filter("_source_system = 'IOT'").count() == 3


def test_csv_export_has_headers_and_reads_back(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1.5), (None, None), ('q"q', 0.1)], "s string, d double")
    export_csv(df.repartition(2), str(tmp_path / "e"))
    assert read_csv(spark, str(tmp_path / "e"), df.schema).exceptAll(df).count() == 0


def test_preview_is_ordered(spark):
    assert [r.id for r in preview(spark.range(100).repartition(5), ["id"], 3).collect()] == [0, 1, 2]


def test_stage_fixes_rows_and_clear_scratch_removes_them(spark):
    staged = stage(spark.range(10).withColumn("r", F.rand()), "test")
    assert staged.exceptAll(staged).count() == 0 and staged.count() == 10
    folder = scratch_path(spark, "other")
    spark.range(1).write.parquet(folder)
    assert clear_scratch(spark) >= 2
    assert not os.path.exists(folder)


def test_scratch_follows_the_session_setting(spark, tmp_path, monkeypatch):
    asked = {}

    class Conf:
        def get(self, key, default=None):
            asked[key] = default
            return f"{tmp_path}/shared/"

    class Session:
        conf = Conf()
        sparkContext = spark.sparkContext

    assert scratch_path(Session(), "x").startswith(f"{tmp_path}/shared/plantmetrics/x-")
    assert "spark.checkpoint.dir" in asked


def test_scratch_is_required_on_a_cluster():
    class Context:
        master = "yarn"
        applicationId = "app"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError):
        scratch_path(Session(), "x")


def test_raw_feeds_are_compressed_and_bounded(spark, tmp_path, same_rows):
    """Arrays of bounded size, each a file; compressed feeds read like plain ones, in the same order."""
    df = spark.range(1000, numPartitions=2).select(F.col("id").cast("string").alias("event_id"), F.lit("é\"[,").alias("etat"))
    tables.write_json_arrays(df, str(tmp_path / "j"), "gzip", 150)
    files = sorted(p.name for p in (tmp_path / "j").glob("part-*"))
    assert len(files) == 8 and all(name.endswith(".gz") for name in files)
    same_rows(df, read_json(spark, str(tmp_path / "j"), df.schema))
    tables.write_json_arrays(df.limit(0), str(tmp_path / "none"), "gzip")
    assert read_json(spark, str(tmp_path / "none"), df.schema).isEmpty()
    export_csv(df, str(tmp_path / "c"), "gzip", 150)
    assert len(list((tmp_path / "c").glob("part-*.csv.gz"))) == 8
    same_rows(df, read_csv(spark, str(tmp_path / "c"), df.schema))


def test_layer_tables_are_packed(spark, tmp_path, same_rows):
    df = spark.range(100).selectExpr("id", "cast(id AS string) AS name")
    write_table(df, str(tmp_path / "t"))
    assert list((tmp_path / "t").glob("*.zstd.parquet"))
    same_rows(df, read_table(spark, str(tmp_path / "t")))
