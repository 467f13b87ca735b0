"""Industrial telemetry analytics on Spark: readings in, health and anomalies out."""
