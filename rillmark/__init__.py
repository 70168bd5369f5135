"""rillmark: clickstream analytics on a layered lake, written as plain Spark jobs.

Every operator is a ``DataFrame -> DataFrame`` function. Nothing in the
library pulls raw rows to the driver or registers a Python UDF.
"""
