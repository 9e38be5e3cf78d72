"""starmart: star-schema analytics on Spark.

Typed loading, SCD2 history, point-in-time joins, weighted bridges and the
business questions built on them, all as DataFrame plans.
"""
