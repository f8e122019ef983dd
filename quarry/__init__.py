"""quarry: lake-to-warehouse analytics on Spark DataFrames.

Layers: ``functions`` (column expressions), ``sources`` (scans, sinks, the test
binding), ``operators`` (cleaning, quality, modelling, global orderings),
``plans`` (ingest and load jobs, the report suite), ``streaming`` (incremental
ingest of newly landed files).
"""

__version__ = "0.1.0"
