"""tessera: a PySpark toolkit for data preparation, profiling, statistics,
text mining and supervised learning on large tables.

Every operator is a function ``DataFrame -> DataFrame`` (or returns a fitted
Spark ML model) built from the public DataFrame, SQL and ML APIs, so that the
data work runs on executors and Catalyst plans it.
"""

__version__ = "0.1.0"
