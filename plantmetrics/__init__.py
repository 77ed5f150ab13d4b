"""Industrial telemetry analytics on Spark: layered tables, cleaning operators and plant KPIs."""
