"""lagoon: panel (entity x time) feature building and forecasting on Spark.

Everything is expressed with DataFrames, Spark SQL functions, window
specifications and Spark ML stages; NumPy only runs inside Arrow batches
that Spark partitions and schedules (the sequence trainer).
"""

__version__ = "0.1.0"
