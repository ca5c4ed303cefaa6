"""Sums of facts by the attributes of a dimension, for dimensions and keys of any size."""

from pyspark.sql import functions as F


def sum_by_attribute(fact, dimension, key, attributes, measures, group_by=()):
    """Sum additive ``measures`` of ``fact`` by dimension attributes (left join on ``key``).

    Facts are summed per key before the join, within each task before they are shuffled, so a key
    holding a third of all rows reaches the join as one row per group. The join then has at most one
    row for each key and group, and the optimizer chooses how to run it from what it sees at run time.
    """
    per_key = fact.groupBy(key, *group_by).agg(*[e.alias(n) for n, e in measures.items()])
    return (
        per_key.join(dimension.select(key, *attributes), key, "left")
        .groupBy(*group_by, *attributes)
        .agg(*[F.sum(n).alias(n) for n in measures])
    )


def present(dimension):
    """A dimension as it is now: a frame, or a function that reads it again."""
    return dimension() if callable(dimension) else dimension
