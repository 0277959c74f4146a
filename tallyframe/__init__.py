"""tallyframe: table analytics for finance, commerce and series data on Spark.

Every operator is a function ``DataFrame -> DataFrame`` that stays lazy, keys its
shuffles on an entity / group column and is written with built-in Spark
expressions. Python workers appear only for small per-entity models
(``applyInPandas``) and per-partition gradient steps (``mapInPandas``).
"""

__version__ = "0.1.0"
