"""Declared schemas of the raw sources. Dates stay text until the silver layer parses them."""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


SENSORS = _struct(
    timestamp=T.StringType(),
    machine_id=T.StringType(),
    temperature_c=T.DoubleType(),
    vibration_mms=T.DoubleType(),
    pression_bar=T.DoubleType(),
    courant_a=T.DoubleType(),
    statut_capteur=T.StringType(),
)

SCADA = _struct(
    event_id=T.StringType(),
    timestamp=T.StringType(),
    machine_id=T.StringType(),
    etat=T.StringType(),
    operateur_id=T.StringType(),
    code_alarme=T.StringType(),
    description=T.StringType(),
)

MES = _struct(
    ordre_id=T.StringType(),
    produit_id=T.StringType(),
    machine_id=T.StringType(),
    date_debut=T.StringType(),
    date_fin_prevue=T.StringType(),
    date_fin_reelle=T.StringType(),
    quantite_prevue=T.IntegerType(),
    quantite_produite=T.IntegerType(),
    taux_rebut_pct=T.DoubleType(),
)

MAINTENANCE = _struct(
    intervention_id=T.StringType(),
    date_intervention=T.StringType(),
    machine_id=T.StringType(),
    type_intervention=T.StringType(),
    duree_heures=T.DoubleType(),
    technicien_id=T.StringType(),
    cout_eur=T.DoubleType(),
    description_panne=T.StringType(),
    pieces_changees=T.StringType(),
)

STAGE_REPORT = _struct(
    stage=T.StringType(),
    table=T.StringType(),
    rows=T.LongType(),
    seconds=T.DoubleType(),
    status=T.StringType(),
    bad_rows=T.LongType(),
)
