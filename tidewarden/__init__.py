"""Station telemetry analytics on Spark: readings in, alerts, history, forecasts and views out."""
