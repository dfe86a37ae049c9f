"""millrace: market time-series analytics written as Spark DataFrame operators."""
