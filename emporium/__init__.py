"""Spark-native commerce analytics: raw shop sources -> staging -> marts.

Every model is a lazy function from DataFrames to a DataFrame; nothing is
collected to the driver except one-row control values (watermarks, touched
partition lists) in the physical write helpers.
"""

__all__ = ["session"]
