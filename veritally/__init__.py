"""Data-quality rules, quarantine ETL and source-to-report reconciliation on Spark."""
