"""Event-time feature computation, pattern detection and feature storage on Spark DataFrames."""
