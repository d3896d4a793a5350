"""Layer operators: Silver, Gold, features, extract, forecast, metrics, serving."""
