"""Reusable Spark operators: incremental writes, SCD2, as-of, quality, metrics."""
