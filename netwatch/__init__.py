"""netwatch: routing and name-lookup event analytics on Spark.

Every rule is one DataFrame function that runs unchanged on a batch table
or a Structured Streaming source.
"""

__version__ = "0.1.0"
