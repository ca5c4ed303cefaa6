"""Upserts as DataFrame operators: state in, state out. Keys match null-safely."""

from pyspark.sql import functions as F

from ..functions.expressions import same_keys


def upsert_replace(target, source, keys):
    """Rows of ``source`` replace rows of ``target`` with the same keys; others are kept."""
    kept = target.join(source.select(*keys).distinct(), same_keys(target, source, keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def upsert_add(target, source, keys, amounts):
    """``amounts`` of equal keys are added; new keys are inserted."""
    both = target.unionByName(source.select(*target.columns))
    return both.groupBy(*keys).agg(*[F.sum(a).alias(a) for a in amounts]).select(*target.columns)


def absent_from(target, source, keys):
    """Distinct ``source`` rows whose keys are not in ``target`` yet."""
    fresh = source.dropDuplicates(keys)
    return fresh.join(target.select(*keys), same_keys(fresh, target, keys), "left_anti")


def insert_if_absent(target, source, keys):
    return target.unionByName(absent_from(target, source, keys).select(*target.columns))


def replace_group(target, source, group):
    """Whole groups are replaced: every row of a group named in ``source`` gives way."""
    return upsert_replace(target, source, group)
