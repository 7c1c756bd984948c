"""tillpoint — retail feature, data-quality and forecasting jobs expressed as Spark DataFrame plans.

Every operator takes and returns a ``pyspark.sql.DataFrame``; nothing is collected to the driver except
one-row scalar summaries (statistics, metrics) whose size does not grow with the input.
"""

__version__ = "0.1.0"
