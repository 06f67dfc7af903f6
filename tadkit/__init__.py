"""tadkit: analytical tables (TAD), features, statistics and models on Spark."""

__all__ = ["session", "sources", "functions", "operators", "plans"]
