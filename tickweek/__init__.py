"""tickweek: weekly price rollups and vehicle title bands as Spark jobs."""

__version__ = "0.1.0"
