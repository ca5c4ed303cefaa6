"""Bronze tables: full reload, overwrite, append, increments above a high-water mark, audits."""

from functools import reduce

from pyspark.sql import Observation
from pyspark.sql import functions as F

from . import folders, id_index
from .batches import BatchFolder


def read_table(spark, path, fmt="parquet"):
    return spark.read.format(fmt).load(path)


def stream_table(spark, path, schema, files_per_batch=None, fmt="parquet", **options):
    """Follow an append-only bronze folder, also into the subfolders of its loads.

    ``options`` go to the source, such as those by which a table format skips rewritten files.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", "true")
    reader = reader.options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _counted(df):
    counter = Observation()
    return df.observe(counter, F.count(F.lit(1)).alias("linhas")), counter


VERSION = "versao="


def overwrite(df, path, fmt="parquet"):
    """Replace a table and its schema by a new version folder; the row count comes from the write itself.

    ``current`` sees the new version when its write has finished, so a failed reload leaves the table as
    it was. The version before stays for readers that have begun; older ones go.
    """
    spark = df.sparkSession
    versions = folders.committed(spark, path, VERSION)
    observed, counter = _counted(df)
    observed.write.format(fmt).mode("overwrite").save(f"{path}/{VERSION}{(versions or [0])[-1] + 1}")
    for old in versions[:-1]:
        folders.delete(spark, f"{path}/{VERSION}{old}")
    return counter.get["linhas"]


def current(spark, path, fmt="parquet"):
    """The latest finished version of a table that is replaced as a whole."""
    versions = folders.committed(spark, path, VERSION)
    if not versions:
        raise FileNotFoundError(path)
    return read_table(spark, f"{path}/{VERSION}{versions[-1]}", fmt)


def append(df, path, fmt="parquet", *partition_by):
    observed, counter = _counted(df)
    observed.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)
    return counter.get["linhas"]


def full_reload(tables, root, fmt="parquet"):
    """Reload every bronze table from its source frame; rows written per table."""
    return {name: overwrite(df, f"{root}/{name}", fmt) for name, df in tables.items()}


class Increments:
    """A table that grows by loads, with the ids it holds in an index beside it.

    What is stored decides: ids of loads that ended before they were indexed are indexed by the next one, so a load that
    failed at any point adds nothing twice.
    """

    def __init__(self, path, schema, id_column):
        self.id_column = id_column
        self.rows = BatchFolder(path, schema)
        self.index = BatchFolder(f"{path}/_indice", id_index.SCHEMA, fold=id_index.folded)

    def high_water_mark(self, spark):
        """Largest id ever loaded, None without one; it is noted with each load."""
        self._catch_up(spark)
        return self.index.note(spark).get("maior")

    def _catch_up(self, spark):
        """Index the loads that are not in the index yet."""
        loads, indexed = self.rows.finished(spark), self.index.finished(spark)
        done = indexed[-1][1] if indexed else -1
        if not loads or loads[-1][1] <= done:
            return
        counter = Observation()
        ids = self.rows.read(spark, since=done + 1).select(self.id_column)
        top = self.index.note(spark).get("maior")
        ids = ids.observe(counter, F.max(self.id_column).alias("maior"))
        self.index.write(id_index.of(ids, self.id_column), loads[-1][1],
                         lambda: {"maior": max(v for v in (top, counter.get["maior"]) if v is not None)})

    def load(self, source, overlap=None):
        """Append the rows of ``source`` whose ids are not stored; returns their number."""
        spark = source.sparkSession
        mark = self.high_water_mark(spark)
        fresh = source
        if mark is not None:
            if overlap is not None:
                fresh = fresh.filter(F.col(self.id_column) > mark - overlap)
            fresh = id_index.absent(fresh, self.index.read(spark), self.id_column)
        loads = self.rows.finished(spark)
        rows = self.rows.write(fresh, loads[-1][1] + 1 if loads else 0, keep_empty=False)
        self._catch_up(spark)
        return rows


def _stored_schema(spark, path):
    """The schema of the newest load."""
    entries = BatchFolder(path, None).finished(spark)
    return spark.read.parquet(BatchFolder(path, None).folder(entries[-1])).schema if entries else None


def high_water_mark(spark, path, id_column):
    """Largest id in an incrementally loaded table, 0 when it is missing or empty."""
    schema = _stored_schema(spark, path)
    return 0 if schema is None else Increments(path, schema, id_column).high_water_mark(spark) or 0


def ingest_increment(source, path, id_column, overlap=None):
    """Append what is new in ``source``; rerun it at any interval. Returns the rows appended.

    Every id of the source is looked up in the index, so an id that arrives late is found however old it is; with
    ``overlap`` only ids from that far below the largest are looked at, a filter that reaches the source.
    Rows without an id cannot be told apart from stored ones and are refused.
    """
    if not source.filter(F.col(id_column).isNull()).limit(1).isEmpty():
        raise ValueError(f"rows without {id_column}")
    return Increments(path, source.schema, id_column).load(source, overlap)


def ingested(spark, path):
    """All rows of an incrementally loaded table."""
    schema = _stored_schema(spark, path)
    if schema is None:
        raise FileNotFoundError(path)
    return BatchFolder(path, schema).read(spark)


def id_bounds(df, id_column):
    return df.agg(F.min(id_column).alias("min_id"), F.max(id_column).alias("max_id"))


def row_counts(tables):
    """Rows per table (tabela, linhas)."""
    counts = [
        df.agg(F.lit(name).alias("tabela"), F.count(F.lit(1)).alias("linhas"))
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)
