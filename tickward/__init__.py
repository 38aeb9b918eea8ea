"""Price-threshold rules evaluated against a feed of price ticks, on Spark.

Operators take and return DataFrames; jobs in ``plans`` and ``streaming`` bind
them to sources and sinks.
"""

__version__ = "0.1.0"
