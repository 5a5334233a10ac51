"""strata: layered (bronze / silver / gold) indicator analytics on Spark.

Every table is a DataFrame -> DataFrame builder made of built-in Spark
expressions; reading and writing happen only in ``strata.plans.run``.
"""

__all__ = ["session"]
