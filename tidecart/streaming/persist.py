"""Messages persisted to bronze, in folders of micro-batches that are merged as they grow old; unreadable ones beside them."""

from functools import partial

from ..operators.cleaning import parse_messages, rejected_messages
from ..schemas import TRANSACTION_MESSAGE, TRANSACTION_ROW, WEB_EVENT_MESSAGE, WEB_EVENT_ROW
from ..sources.batches import BatchFolder

INTERVAL = "10 seconds"

_TOPICS = {
    "transacoes_vendas": (TRANSACTION_MESSAGE, TRANSACTION_ROW),
    "eventos_web": (WEB_EVENT_MESSAGE, WEB_EVENT_ROW),
}


def table_rows(messages, table):
    """Parsed messages cut to the columns of the stored table."""
    schema, columns = _TOPICS[table]
    return parse_messages(messages, schema, columns).select(*columns)


def write_batch(path, batch, batch_id):
    """A replayed batch overwrites its own folder: no row is lost, none is stored twice."""
    BatchFolder(path, batch.schema).write(batch, batch_id)


def start_persist(messages, table, path, checkpoints, sink=None, rejects=None, **trigger):
    """Persist one topic. A failed batch is retried by the stream, never dropped.

    The text of unreadable messages goes to ``rejects`` (by default ``path`` with ``-rejeitados``) under
    the same batch id, so nothing is gone once the offset is committed. ``sink(batch, batch_id)``
    replaces the parquet folders of the rows by another idempotent writer.
    """
    write = sink or partial(write_batch, path)
    refuse = partial(write_batch, rejects or rejects_path(path))

    def store(batch, batch_id):
        write(table_rows(batch, table), batch_id)
        refuse(rejected_messages(batch, _TOPICS[table][0]), batch_id)

    return (
        messages.writeStream.queryName(f"persist_{table}").foreachBatch(store)
        .option("checkpointLocation", f"{checkpoints}/persist_{table}")
        .trigger(**(trigger or {"processingTime": INTERVAL})).start()
    )


def rejects_path(path):
    return f"{path}-rejeitados"


def rejected(spark, path):
    """The unreadable messages of finished batches."""
    return BatchFolder(path, "value string").read(spark)


def persisted(spark, path, table):
    """All rows of finished batches."""
    schema, columns = _TOPICS[table]
    fields = [f"{c} {schema[c].dataType.simpleString()}" for c in columns]
    return BatchFolder(path, ", ".join(fields)).read(spark)
