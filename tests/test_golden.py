"""Published plant figures, where a copy is at hand: ``PLANTMETRICS_GOLDEN_DIR`` with ``raw`` and ``gold/csv``."""

import os

import pytest
from pyspark.sql import functions as F

from plantmetrics import schemas
from plantmetrics.plans import gold, silver
from plantmetrics.sources import read_csv

GOLDEN = os.environ.get("PLANTMETRICS_GOLDEN_DIR")
pytestmark = pytest.mark.skipif(not GOLDEN, reason="PLANTMETRICS_GOLDEN_DIR is not set")


def expected(spark, name, schema):
    return read_csv(spark, f"{GOLDEN}/gold/csv/{name}.csv", schema)


def close(actual, wanted, keys):
    """Same keys, integers and texts equal, doubles within their last digits."""
    doubles = [n for n, t in actual.dtypes if t == "double"]
    others = [n for n, t in actual.dtypes if t != "double" and n not in keys]
    renamed = wanted.select(*keys, *[F.col(c).alias(f"w_{c}") for c in (*doubles, *others)])
    joined = actual.join(renamed, keys, "full").collect()
    assert len(joined) == actual.count() == wanted.count()
    for row in joined:
        for name in others:
            assert row[name] == row[f"w_{name}"], (name, row)
        for name in doubles:
            assert row[name] == pytest.approx(row[f"w_{name}"], rel=1e-9, abs=1e-9), (name, row)


@pytest.fixture
def mes(spark):
    return silver.silver_mes(read_csv(spark, f"{GOLDEN}/raw/mes_orders.csv", schemas.MES))


def test_production_summary(spark, mes):
    actual = gold.gold_production_summary(mes)
    close(actual, expected(spark, "gold_production_summary", actual.schema), ["mois", "produit_id"])


def test_order_status(mes):
    counts = {r.ordre_statut: r["count"] for r in mes.groupBy("ordre_statut").count().collect()}
    assert counts == {"EN_COURS": 17, "EN_RETARD": 106, "A_TEMPS": 77}
    delay = mes.agg(F.min("retard_heures"), F.max("retard_heures")).first()
    assert [round(v, 4) for v in delay] == [-0.4994, 7.4692]


def test_maintenance_cost(spark):
    raw = read_csv(spark, f"{GOLDEN}/raw/maintenance_logs.csv", schemas.MAINTENANCE)
    actual = gold.gold_maintenance_cost(raw)
    close(actual, expected(spark, "gold_maintenance_cost", actual.schema), ["machine_id"])


OEE = (
    "semaine int, machine_id string, nb_mesures_semaine long, sum_arret_minutes double, sum_produite long, "
    "sum_prevue long, sum_rebuts double, disponibilite double, temps_disponible_heures double, performance double, "
    "qualite_oee double, oee_pct double"
)
KPIS = (
    "date date, machine_id string, temp_moyenne double, temp_max double, vibration_moyenne double, "
    "pression_moyenne double, nb_anomalies_capteurs long, nb_mesures long, nb_alarmes long, "
    "duree_arret_minutes double, taux_disponibilite_pct double"
)


def test_weekly_production(spark, mes):
    keys = ["semaine", "machine_id"]
    wanted = expected(spark, "gold_oee", OEE).select(*keys, "sum_produite", "sum_prevue", "sum_rebuts")
    close(gold.weekly_production(mes), wanted, keys)


def test_oee_formulas(spark):
    wanted = expected(spark, "gold_oee", OEE)
    inputs = wanted.select(*wanted.columns[:7])
    close(gold.oee_columns(inputs), wanted, ["semaine", "machine_id"])


def test_weeks_are_sums_of_days(spark):
    days = expected(spark, "gold_kpis_machines", KPIS)
    weeks = days.groupBy(F.weekofyear("date").alias("semaine"), "machine_id").agg(
        F.sum("nb_mesures").alias("nb_mesures_semaine"), F.sum("duree_arret_minutes").alias("sum_arret_minutes")
    )
    wanted = expected(spark, "gold_oee", OEE).select(*weeks.columns)
    close(weeks, wanted, ["semaine", "machine_id"])


def test_daily_availability(spark):
    wanted = expected(spark, "gold_kpis_machines", KPIS)
    availability = gold.add_availability(wanted.drop("taux_disponibilite_pct"))
    close(availability, wanted, ["date", "machine_id"])
