"""DataFrame -> DataFrame operators: cleaning, dedupe, scoring, reports, loads, change capture,
windows, data quality, features and key helpers. No actions inside."""
