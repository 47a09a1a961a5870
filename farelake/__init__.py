"""farelake: a Spark-native booking-fare medallion pipeline.

Every step is a function from DataFrame(s) to a DataFrame; Catalyst plans
and AQE executes them. Layers (staging, bronze, silver, gold) are Parquet
tables managed by :mod:`farelake.sources.lake`.
"""

from farelake.schema import Rules

__all__ = ["Rules"]
