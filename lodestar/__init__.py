"""lodestar: business-data analytics operators as Spark DataFrame plans.

Every public operator takes DataFrames and returns DataFrames. Nothing here
creates a SparkSession at import time; use :func:`lodestar.session.get_spark`.
"""

__version__ = "0.1.0"
