"""Message streams: one JSON text per row in a ``value`` column."""


def kafka_stream(spark, servers, topic, starting="latest", **options):
    """Follow a topic; needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topic).option("startingOffsets", starting)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select("value")


def folder_stream(spark, path, files_per_batch=None):
    """Follow a folder of parquet files with a ``value`` column, subfolders included."""
    reader = spark.readStream.schema("value string").option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
