"""Wind-farm telemetry on Spark: topics, transformations, windows, joins and ledgers."""
