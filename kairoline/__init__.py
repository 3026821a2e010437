"""Regular-interval time-series features, gap filling and model selection on Spark."""
