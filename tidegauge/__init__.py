"""Time-series performance analytics expressed as Spark DataFrame operators."""
