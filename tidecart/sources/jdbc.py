"""Relational sources over JDBC. The driver jar and the URL are the caller's."""

from pyspark.sql import functions as F

# Rows one task should fetch; the number of partitions follows from the id range.
ROWS_PER_PARTITION = 2_000_000


def read_whole(spark, url, table, properties):
    return spark.read.jdbc(url=url, table=table, properties=properties)


def bounds_query(table, id_column):
    """Smallest and largest id and the number of rows, computed by the database; only one row travels."""
    return (f'(SELECT MIN("{id_column}") AS "lo", MAX("{id_column}") AS "hi", COUNT(*) AS "n" FROM {table}) bounds')


def partitions_for(low, high, rows_per_partition=ROWS_PER_PARTITION):
    return max(1, -(-(high - low + 1) // rows_per_partition))


#: Partitions of one read, whatever its ids are.
MOST_PARTITIONS = 2_000
# Ids are dense when their range is at most so many times their number.
_DENSE = 4


def quantiles_query(table, id_column, parts, sample=""):
    """The largest id of each of ``parts`` equal shares of the rows, computed by the database.

    ``sample`` is the database's clause for a sample of a table, such as TABLESAMPLE SYSTEM (1).
    """
    tiles = f'SELECT "{id_column}" AS "id", NTILE({parts}) OVER (ORDER BY "{id_column}") AS "parte" FROM {table} {sample}'.rstrip()
    return f'(SELECT MAX("id") AS "ate" FROM ({tiles}) tiles GROUP BY "parte") quantiles'


def range_predicates(id_column, uppers):
    """Conditions that split all rows at ``uppers``: each row, with or without an id, meets exactly one."""
    column, uppers = f'"{id_column}"', sorted({u for u in uppers if u is not None})[:-1]
    if not uppers:
        return ["1 = 1"]
    inner = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(uppers, uppers[1:])]
    return [f"({column} <= {uppers[0]} OR {column} IS NULL)", *inner, f"{column} > {uppers[-1]}"]


def read_by_id(spark, url, table, id_column, properties, partitions=None, sample="", rows_per_partition=ROWS_PER_PARTITION):
    """Parallel read in id ranges of about as many rows each; an empty table is read plainly.

    The number of partitions follows from the rows and is bounded. Dense ids are cut into equal ranges; ids with wide gaps
    or clusters at their quantiles, of all rows or of a ``sample``.
    """
    bounds = spark.read.jdbc(url=url, table=bounds_query(table, id_column), properties=properties)
    low, high, rows = bounds.first()
    if low is None:
        return read_whole(spark, url, table, properties)
    partitions = partitions or min(MOST_PARTITIONS, partitions_for(1, rows, rows_per_partition))
    if high - low < _DENSE * rows:
        return spark.read.jdbc(url=url, table=table, properties=properties, column=id_column,
                               lowerBound=low, upperBound=high + 1, numPartitions=partitions)
    shares = spark.read.jdbc(url=url, table=quantiles_query(table, id_column, partitions, sample), properties=properties)
    return spark.read.jdbc(url=url, table=table, properties=properties,
                           predicates=range_predicates(id_column, [r[0] for r in shares.collect()]))


def read_above(spark, url, table, id_column, mark, properties, partitions=None):
    """Rows above a high-water mark, as a subquery, so the bounds are those of the new rows."""
    query = f'(SELECT * FROM {table} WHERE "{id_column}" > {int(mark)}) new_rows'
    return read_by_id(spark, url, query, id_column, properties, partitions)


def table_counts(spark, url, tables, properties):
    """Row counts computed by the database."""
    union = " UNION ALL ".join(
        f"SELECT '{t}' AS \"tabela\", COUNT(*) AS \"linhas\" FROM {t}" for t in tables
    )
    counts = spark.read.jdbc(url=url, table=f"({union}) counts", properties=properties)
    return counts.select("tabela", F.col("linhas").cast("long"))
