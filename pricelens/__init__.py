"""pricelens: commodity-price panel analytics expressed as Spark DataFrame jobs.

Sub-packages
------------
sources    table readers (parquet/csv/json/html), the test-data adapter, sinks
functions  column-expression helpers (safe division, guarded correlation, dates)
operators  cleaning, joins, aggregates, window features, scores, analyses
ml         Spark ML jobs (encoding, splits, regressors, clustering, forecasts)
plans      named queries: DataFrame builder + DuckDB oracle SQL
streaming  Structured Streaming price-shock alerts
"""

__version__ = "0.1.0"
