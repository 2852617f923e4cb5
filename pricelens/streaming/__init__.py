from pricelens.streaming.alerts import AlertStore, price_alerts, run_alerts  # noqa: F401
