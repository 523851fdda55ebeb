"""Daily entity time series on Spark: landing, checks, keyed loads and marts."""
