"""Session settings and the shared work folder. Nothing here names a master."""

from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The default int96 timestamps cannot be skipped by row-group statistics.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Distinct-count sketches and windowed sums outgrow a heap-resident state store.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name="tidecart", **overrides):
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark):
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


@contextmanager
def settings(spark, values):
    """Runtime settings for the jobs run inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, str(value))
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
