"""Job-posting matching expressed as Spark DataFrame jobs."""

__all__ = ["functions", "operators", "plans", "schemas", "session", "sources", "streaming"]
