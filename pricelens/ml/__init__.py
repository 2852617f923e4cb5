"""Spark ML jobs: encoding, chronological splits, regressors, classifier,
clustering, isolation forest, recursive and seasonal forecasts, metrics."""
