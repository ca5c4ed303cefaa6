"""Counts and bounds of Parquet tables from their footers: no column is read.

Spark answers MIN, MAX and COUNT of a whole table from the footers when the table is read by the newer Parquet source and the
pushdown is on. Both are settings of a session, so these frames belong to a session of their own beside the caller's.
Numbers and dates have their bounds in the footers; texts and times of day do not, and are read.
"""

from functools import reduce

from pyspark.sql import functions as F

_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def session(spark):
    beside = spark.newSession()
    for key, value in _SETTINGS.items():
        beside.conf.set(key, value)
    return beside


def id_bounds(spark, path, id_column):
    table = session(spark).read.parquet(path)
    return table.agg(F.min(id_column).alias("min_id"), F.max(id_column).alias("max_id"))


def row_counts(spark, paths):
    """Rows of each table (tabela, linhas), from {name: path}."""
    beside = session(spark)
    counts = [beside.read.parquet(path).agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
              for name, path in paths.items()]
    return reduce(lambda a, b: a.unionByName(b), counts)
