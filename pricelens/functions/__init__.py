from pricelens.functions.exprs import (  # noqa: F401
    clip, col, is_weekend, isclose, nan_to_null, paired, pct, pct_change, q4,
    safe_corr, safe_div, sample_std, season, weekday0,
)
