"""pitchside: team-strength models and feature snapshots as Spark DataFrame jobs."""

__version__ = "0.1.0"
