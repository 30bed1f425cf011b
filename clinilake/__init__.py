"""Health-lake analytics on stock Apache Spark.

Every public operator takes and returns lazy DataFrames; nothing here
collects data to the driver or starts a session at import time.
"""

__version__ = "0.1.0"
