"""cabline: event-time analytics over ride, fare, vehicle and trade events on Spark.

Every job is a function from DataFrames to a DataFrame built from Spark's own
expressions, joins, windows and aggregates, so the same code runs on complete
tables (batch) and, where Spark allows it, on streams.
"""

from cabline.session import checkpoint_dir, get_spark  # noqa: F401

__version__ = "0.1.0"
