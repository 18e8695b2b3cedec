"""schedlytics: scheduling and demand-history analytics as PySpark DataFrame jobs."""

__version__ = "0.1.0"
