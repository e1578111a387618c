"""Forecasting: per-series fits in grouped maps, pooled fits in Spark ML, scoring in column expressions."""
