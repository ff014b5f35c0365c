"""dockhand: move, conform, merge and check tables with Spark.

Every operator is a function over DataFrames that Catalyst plans and the
executors run; the driver only holds plans, schemas and small parameter lists.
"""

__version__ = "0.1.0"
