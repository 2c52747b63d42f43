"""larder: retail demand, allocation and inventory-ledger operators on Spark DataFrames.

Every public operator takes and returns a ``pyspark.sql.DataFrame``; nothing
is collected to the driver inside an operator.
"""

__version__ = "0.1.0"
