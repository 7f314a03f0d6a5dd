"""vigil: security-event analytics on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function (or a column
expression) that works the same on a batch table and on a Structured
Streaming source.  Jobs in :mod:`vigil.plans` only wire sources to sinks.
"""

__version__ = "0.1.0"
