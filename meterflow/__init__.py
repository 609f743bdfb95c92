"""Power-usage analytics on Spark: meter readings in, site rollups, derived
metrics, anomaly alerts and data-quality outputs out (batch and streaming)."""

__version__ = "0.1.0"
