"""Keyed JSON snapshots: the latest value of each metric, for dashboards.

A list is published in pages of bounded size, in the order of the frame, so no task ever holds a
whole metric; a metric of up to one page is one JSON document. A key's new version becomes
visible when its write finishes.
"""

from datetime import datetime, timezone

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import folders

PAGE_ROWS = 1000
SCHEMA = "chave string, pagina long, payload string, linhas long, publicado_em timestamp"


def json_lines(df):
    """Rows as JSON text with an id that ascends in the order of the frame.

    Null fields stay in the text, dates and times are ISO 8601, decimals are numbers with all their digits. The id holds the partition in its
    upper bits and counts from 0 in each.
    """
    text = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in df.schema]), {
        "ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    })
    return df.select(text.alias("linha"), F.monotonically_increasing_id().alias("_id"))


def pages(lines, key, shape="list", page_rows=PAGE_ROWS):
    """JSON pages numbered from 0. ``shape`` is "list" or, for a single row, "object".

    A row's position is the number of rows in the partitions before its own plus its place there.
    Only the partition sizes, one row each, are brought together.
    """
    partition, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    sizes = lines.groupBy(partition.alias("_partition")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_partition", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    placed = lines.withColumn("_partition", partition).join(F.broadcast(starts), "_partition")
    placed = placed.select("linha", (F.col("_start") + place).alias("_position"))
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct("_position", "linha"))), lambda s: s["linha"]
    )
    body = F.array_join(ordered, ",")
    if shape == "list":
        body = F.concat(F.lit("["), body, F.lit("]"))
    elif shape != "object":
        raise ValueError(f"unknown shape {shape!r}")
    page = F.floor(F.col("_position") / page_rows)
    return placed.groupBy(page.alias("pagina")).agg(
        body.alias("payload"), F.count(F.lit(1)).alias("linhas")
    ).select(F.lit(key).alias("chave"), "pagina", "payload", "linhas")


class SnapshotStore:
    """Snapshots under one folder, a subfolder per key and version.

    ``forward``, if given, is called with the iterator of pages of each partition of the stored
    version, so that an external key-value store can be fed by the executors; ``switch(key, version)``
    is called on the driver after all its pages are there. A version is named by its time of
    publication in microseconds. Nothing is deleted unless ``hours`` is given: then versions older
    than that go, but never the latest.
    """

    def __init__(self, root, forward=None, switch=None, hours=None):
        self.root = root
        self.forward = forward
        self.switch = switch
        self.hours = hours

    def _folder(self, key):
        return f"{self.root}/{key.replace(':', '__')}"

    def _versions(self, spark, key):
        return folders.committed(spark, self._folder(key), "v")

    def publish(self, df, key, shape="list", on_empty="skip", at=None):
        """Publish a frame under ``key``. An empty frame is skipped or refused."""
        lines = json_lines(df).persist()
        try:
            if lines.isEmpty():
                if on_empty == "raise":
                    raise ValueError(f"nothing to publish under {key}")
                return False
            if shape == "object" and lines.limit(2).count() > 1:
                raise ValueError(f"{key} is published as one object, but the frame has several rows")
            self._store(pages(lines, key, shape), key, at)
            return True
        finally:
            lines.unpersist()

    def publish_value(self, spark, value, key, at=None):
        """Publish a single text or number."""
        if value is None or not isinstance(value, (str, int, float)):
            raise TypeError(f"cannot publish {value!r} under {key}")
        one = spark.range(1).select(
            F.lit(key).alias("chave"), F.lit(0).cast("long").alias("pagina"),
            F.lit(str(value)).alias("payload"), F.lit(1).cast("long").alias("linhas"),
        )
        self._store(one, key, at)

    def _store(self, paged, key, at):
        spark, at = paged.sparkSession, at or datetime.now(timezone.utc)
        number = max((self._versions(spark, key) or [0])[-1] + 1, _micros(at))
        stamped = paged.withColumn("publicado_em", F.lit(at).cast("timestamp"))
        stamped.write.mode("overwrite").parquet(f"{self._folder(key)}/v{number}")
        if self.forward:
            self.fetch(spark, key).foreachPartition(self.forward)
            if self.switch:
                self.switch(key, number)
        if self.hours is not None:
            self.expire(spark, key, self.hours, at)

    def fetch(self, spark, key):
        """The latest pages of a key, no rows when it was never published."""
        versions = self._versions(spark, key)
        if not versions:
            return spark.createDataFrame([], SCHEMA)
        return spark.read.schema(SCHEMA).parquet(f"{self._folder(key)}/v{versions[-1]}")

    def rows(self, spark, key, schema):
        """The latest value decoded to rows, whether it was published as list or object.

        ``pagina`` and ``posicao`` give the published order. A page that is not JSON of that schema is
        an error.
        """
        return decode(self.fetch(spark, key), schema)

    def value(self, spark, key, kind="string"):
        """The latest single text or number, as column ``valor``."""
        return self.fetch(spark, key).select(F.col("payload").cast(kind).alias("valor"))

    def history(self, spark, key):
        """All retained versions of a key."""
        versions = self._versions(spark, key)
        if not versions:
            return spark.createDataFrame([], SCHEMA)
        return spark.read.schema(SCHEMA).parquet(*[f"{self._folder(key)}/v{n}" for n in versions])

    def expire(self, spark, key, hours, now):
        """Drop versions published more than ``hours`` before ``now``, all but the latest."""
        for old in self._versions(spark, key)[:-1]:
            if old < _micros(now) - int(hours * 3_600_000_000):
                folders.delete(spark, f"{self._folder(key)}/v{old}")


def _micros(at):
    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return int(at.timestamp()) * 1_000_000 + at.microsecond


def decode(fetched, schema):
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    parsed = fetched.select(
        "pagina", F.posexplode(F.from_json("payload", T.ArrayType(schema), {"mode": "FAILFAST"})).alias("posicao", "linha")
    )
    return parsed.select("pagina", "posicao", "linha.*")


def within_retention(history, hours, now):
    """Snapshots young enough to matter to a real-time reader."""
    horizon = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(hours)} HOURS")
    return history.filter(F.col("publicado_em") >= horizon)
