"""Public-health administrative records on Spark: load, type, enrich, query, profile, export."""

__version__ = "0.1.0"
