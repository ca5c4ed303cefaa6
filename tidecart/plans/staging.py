"""Input folders for the streaming queries, derived from the given tables in several loads."""

import time
import uuid

from pyspark.sql import functions as F

from ..operators import products
from ..schemas import TRANSACTION_MESSAGE, WEB_EVENT_MESSAGE
from ..session import settings, shared_folder
from ..sources import folders, lake, tables
from ..sources.monthly import MonthlyTable

# Lines of one order arrive in different loads, so later loads touch days and quarters again.
LOADS = 3
_LOAD = "CASE WHEN linha <= 2 THEN 0 WHEN linha <= 5 THEN 1 ELSE 2 END"

SALES_COLUMNS = [
    "id_transacao", "id_pedido", "id_usuario", "id_produto", "quantidade_produto",
    "valor_total_compra", "data_compra",
]
_staged = {}


def new_folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _once(spark, folder, name, write):
    """Stage each input once per application; later queries read the same folder."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _staged:
        path = new_folder(spark, f"staged-{name}")
        write(path)
        _staged[key] = path
    return _staged[key]


# Row groups of JSON text small enough for several tasks to decode one file.
_TEXT_ROW_GROUP = 8 * 1024 * 1024


def _in_loads(df, path, load, **options):
    """One folder per load of a stored table, written one after the other: streams take files by age.

    Each load has as many files as the frame has partitions, so a third of the files is one load.
    """
    loads = df.withColumn("carga", F.expr(load) if isinstance(load, str) else load).drop("linha")
    files = loads.rdd.getNumPartitions()
    for number in range(LOADS):
        part = loads.filter(F.col("carga") == number).drop("carga")
        part.repartition(files).write.options(**options).parquet(f"{path}/carga={number}")


# Of the Parquet file of the lines, what one partition of a join is to hold at most, so that its sort fits in memory.
_JOINED_BYTES = 4 * 1024 * 1024
# Shuffled bytes that a task is to join and write as text: a fourth of what adaptive execution puts together by default.
_JOINED_TASK = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 * 1024 * 1024}


def _sales(spark, folder, *columns):
    """Sales for staging, joined in the same way at any size: no table comes to the driver to be broadcast."""
    return tables.sales(spark, folder, *columns, strategy="merge")


# What one task is to read of the tables at most: with many partitions to shuffle to, it holds all its rows to sort them.
_READ_BYTES = 32 * 1024 * 1024


def _join_settings(spark, folder):
    """As many shuffle partitions as the lines need; adaptive execution puts together those that are too many."""
    enough = -(-folders.size(spark, f"{folder}/lineitem.parquet") // _JOINED_BYTES)
    return settings(spark, {
        "spark.sql.shuffle.partitions": max(enough, int(spark.conf.get("spark.sql.shuffle.partitions"))),
        "spark.sql.files.maxPartitionBytes": _READ_BYTES,
    })


def _joined_in_loads(spark, folder, sales, path, **options):
    """One folder per load, all written in one pass over the joined sales: partitions of the join become files of each load.

    Neither the join nor its texts are shuffled again, and a file for each load is open in a task, so nothing is sorted.
    Streams take files by age: those of a load are dated a second after those of the load before.
    """
    loads = sales.withColumn("carga", F.expr(_LOAD)).drop("linha")
    with _join_settings(spark, folder), settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": LOADS, **_JOINED_TASK}):
        loads.write.options(**options).partitionBy("carga").parquet(path)
    written = int(time.time() * 1000)
    for number in range(LOADS):
        load = f"{path}/carga={number}"
        if not folders.exists(spark, load):
            spark.createDataFrame([], loads.drop("carga").schema).write.options(**options).parquet(load)
        folders.date_files(spark, load, written - 1000 * (LOADS - number))


def files_per_batch(spark, path):
    """A third of the staged files, so the stream takes several micro-batches at any scale."""
    return max(1, -(-len(spark.read.parquet(path).inputFiles()) // LOADS))


def bronze_sales(spark, folder):
    def write(path):
        _joined_in_loads(spark, folder, _sales(spark, folder, *SALES_COLUMNS, "linha"), path)
    return _once(spark, folder, "vendas", write)


# Shuffled bytes that a task is to join and write by month. It sorts lines, orders and, by month, what it writes, all three held
# at a time: half of what adaptive execution puts together by default, which makes half the files of still smaller tasks.
_MONTHS_TASK = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 * 1024 * 1024}


def monthly_sales(spark, folder):
    """Sales stored by month of purchase, written by the tasks that join them: a file for each month from each of them."""
    columns = [*SALES_COLUMNS, "metodo_pagamento", "linha"]

    def write(path):
        with _join_settings(spark, folder), settings(spark, _MONTHS_TASK):
            MonthlyTable(path, "data_compra").write(_sales(spark, folder, *columns), shuffle=False)
    return MonthlyTable(_once(spark, folder, "vendas-por-mes", write), "data_compra")


def published_ranking(spark, folder):
    """The quarterly ranking with names, as it is stored for readers."""
    def write(path):
        units = products.units_by_quarter(monthly_sales(spark, folder).read(spark))
        named = products.with_product_names(products.rank_in_quarter(units), tables.catalog(spark, folder))
        named.hint("rebalance", "ano", "trimestre").write.partitionBy("ano", "trimestre").parquet(path)
    return spark.read.parquet(_once(spark, folder, "ranking", write))


def sales_messages(spark, folder):
    """Transactions as JSON messages."""
    fields = TRANSACTION_MESSAGE.fieldNames()

    def write(path):
        texts = _sales(spark, folder, *fields, "linha").select(as_json(fields), "linha")
        _joined_in_loads(spark, folder, texts, path, **{"parquet.block.size": _TEXT_ROW_GROUP})
    return _once(spark, folder, "mensagens-vendas", write)


# Events of all times are in each load: carts come again, and most events of a load are late.
_EVENT_LOAD = "cast(pmod(id_evento, 3) AS int)"


def event_messages(spark, folder, unreadable=None):
    """Web events as JSON messages; those of one type may be left as bare words, which are no JSON objects."""
    def write(path):
        events = tables.web_events(spark, folder)
        text = as_json(WEB_EVENT_MESSAGE.fieldNames())
        if unreadable:
            text = F.when(F.col("tipo_evento") == unreadable, F.col("tipo_evento")).otherwise(text).alias("value")
        _in_loads(events.select(text, F.expr(_EVENT_LOAD).alias("carga")), path, "carga")
    return _once(spark, folder, f"mensagens-eventos-{unreadable or 'todas'}", write)


def bronze_events(spark, folder):
    """The events table in loads of interleaved ids."""
    def write(path):
        _in_loads(tables.table(spark, folder, "events"), path, "cast(pmod(event_id, 3) AS int)")
    return _once(spark, folder, "eventos", write)


def events_by_time(spark, folder):
    """The events table in three loads by time; of the first third every fiftieth comes in the last load."""
    def write(path):
        events = tables.table(spark, folder, "events")
        span = events.agg(F.struct(F.min("ts").alias("a"), F.max("ts").alias("b")).alias("s")).scalar()
        place = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(span["a"].cast("timestamp"))) * 3
                        / (F.unix_micros(span["b"].cast("timestamp")) - F.unix_micros(span["a"].cast("timestamp")) + 1))
        late = (place == 0) & (F.col("event_id") % 50 == 0)
        _in_loads(events, path, F.when(late, 2).otherwise(place.cast("int")))
    return _once(spark, folder, "eventos-por-tempo", write)


def as_json(fields):
    return F.to_json(F.struct(*fields), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value")


def follow(spark, path):
    """Stream a staged folder, a third of its files in each micro-batch."""
    schema = spark.read.parquet(path).drop("carga").schema
    return lake.stream_table(spark, path, schema, files_per_batch(spark, path))
