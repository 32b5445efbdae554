"""Transaction-fraud analytics on Spark: load, clean, profile, report, derive features, model, evaluate."""
