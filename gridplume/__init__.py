"""Daily roll-up, lake, marts and checks for unit-level power-plant readings, as Spark jobs."""

__version__ = "0.1.0"
