"""Plant feeds derived from the test tables: every row of events, orders and lineitem is used.

Attributes that a plant feed has and the test tables lack (timestamp layout, dropped measures) follow
``k``, the number in ``events.props``. Error events are sent twice, the copy with other values and a
higher row id, as a gateway that retries would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINEAGE = ("_ingestion_timestamp", "_source_file", "_source_system", "_row_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("machine_id"),
        "event_type",
        "value",
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
    )


def _timestamp_text() -> Column:
    k, ts = F.col("k"), F.col("ts")
    return (
        F.when(k < 40, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(k < 80, F.date_format(ts, "dd/MM/yyyy HH:mm"))
        .when(k < 86, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(k < 92, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(k < 98, F.date_format(ts, "dd/MM/yyyy HH:mm:ss"))
        .otherwise(F.concat(F.lit("n/a "), F.col("event_id").cast("string")))
    )


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings plus ``_row_id``."""
    events = _events(spark, sf_dir).withColumn("timestamp", _timestamp_text())
    k, value = F.col("k"), F.col("value")

    def unless_dropped(low: int, high: int, measure: Column) -> Column:
        return F.when(~k.between(low, high), measure)

    sent = events.select(
        "timestamp",
        "machine_id",
        unless_dropped(10, 12, value - 15.0).alias("temperature_c"),
        unless_dropped(20, 22, value / 100.0 - 0.05).alias("vibration_mms"),
        unless_dropped(30, 33, k.cast("double") / 10.0 - 0.1).alias("pression_bar"),
        unless_dropped(41, 43, k.cast("double")).alias("courant_a"),
        F.lit("OK").alias("statut_capteur"),
        (F.col("event_id") * 2).alias("_row_id"),
    )
    resent = events.filter("event_type = 'error'").select(
        "timestamp",
        "machine_id",
        (value + 1.0).alias("temperature_c"),
        (value / 100.0).alias("vibration_mms"),
        F.lit(4.0).alias("pression_bar"),
        F.lit(12.0).alias("courant_a"),
        F.lit("OK").alias("statut_capteur"),
        (F.col("event_id") * 2 + 1).alias("_row_id"),
    )
    return sent.unionByName(resent)


def hot_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sensors`` with every third reading, and its copy, on machine M0."""
    hot = F.floor(F.col("_row_id") / 2) % 3 == 0
    return sensors(spark, sf_dir).withColumn("machine_id", F.when(hot, F.lit("M0")).otherwise(F.col("machine_id")))


def scada(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw state events plus ``_row_id``."""
    events = _events(spark, sf_dir)
    kind = F.col("event_type")
    states = events.select(
        F.concat(F.lit("EVT_"), F.col("event_id").cast("string")).alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "machine_id",
        F.when(kind == "error", "ALARME")
        .when(kind == "purchase", "ARRET")
        .when(kind == "signup", "MAINTENANCE")
        .otherwise("EN_MARCHE")
        .alias("etat"),
        F.concat(F.lit("OP_"), F.col("k").cast("string")).alias("operateur_id"),
        F.when(kind == "error", F.concat(F.lit("alm_"), F.floor(F.col("k") / 10).cast("string"))).alias("code_alarme"),
        F.concat(F.lit("état "), kind).alias("description"),
        (F.col("event_id") * 2).alias("_row_id"),
    )
    resent = states.filter("etat = 'ALARME'").withColumns(
        {"code_alarme": F.lit("alm_copy"), "_row_id": F.col("_row_id") + 1}
    )
    return states.unionByName(resent)


def mes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw production orders: one per order line."""
    started = F.col("o_orderdate").cast("timestamp")

    def text(ts: Column) -> Column:
        return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")

    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.concat(F.lit("PROD_"), F.substring("o_orderpriority", 1, 1)).alias("produit_id"),
        text(started).alias("date_debut"),
        text(started + F.expr("INTERVAL 30 DAYS")).alias("date_fin_prevue"),
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, "l_orderkey")
        .select(
            F.concat_ws("_", F.lit("ORD"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
            .alias("ordre_id"),
            "produit_id",
            F.concat(F.lit("M"), F.col("l_suppkey").cast("string")).alias("machine_id"),
            "date_debut",
            "date_fin_prevue",
            F.when(F.col("l_linestatus") != "O", text(F.col("l_shipdate").cast("timestamp"))).alias("date_fin_reelle"),
            F.col("l_quantity").cast("int").alias("quantite_prevue"),
            F.floor(F.col("l_quantity") * (F.lit(1.0) - F.col("l_discount"))).cast("int").alias("quantite_produite"),
            (F.col("l_tax") * 100.0).alias("taux_rebut_pct"),
        )
    )


def maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw interventions: one per order line."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.concat_ws("_", F.lit("INT"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
            "intervention_id"
        ),
        F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("date_intervention"),
        F.concat(F.lit("M"), F.col("l_suppkey").cast("string")).alias("machine_id"),
        F.when(F.col("l_returnflag") == "R", "CORRECTIVE").otherwise("PREVENTIVE").alias("type_intervention"),
        F.col("l_quantity").alias("duree_heures"),
        F.concat(F.lit("TECH_"), F.col("l_linenumber").cast("string")).alias("technicien_id"),
        F.col("l_extendedprice").alias("cout_eur"),
        F.concat(F.lit("panne \""), F.col("l_returnflag"), F.lit("\", pièce")).alias("description_panne"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("pièce / "), F.col("l_partkey").cast("string"))).alias(
            "pieces_changees"
        ),
    )


def write_json_arrays(df: DataFrame, path: str, compression: str = "none", most: int = 50_000) -> None:
    """JSON arrays of up to ``most`` rows, a file each: an array is read as one text, so its size is bounded."""

    def arrays(batches):
        import pyarrow as pa

        def array(rows):
            return pa.RecordBatch.from_pydict({"value": pa.array(["[" + "\n,".join(rows) + "\n]"], pa.string())})

        held, some = [], False
        for batch in batches:
            held += batch.column(0).to_pylist()
            while len(held) >= most:
                yield array(held[:most])
                held, some = held[most:], True
        if held or not some:
            yield array(held)

    packed = df.select(F.to_json(F.struct("*")).alias("value")).mapInArrow(arrays, "value string")
    writer = packed.write.mode("overwrite").option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
    writer.option("maxRecordsPerFile", 1).text(path)
