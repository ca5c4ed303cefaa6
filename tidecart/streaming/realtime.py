"""Running totals over the message streams, published as snapshots after every micro-batch."""

from dataclasses import dataclass
from typing import Callable

from ..operators import kpis
from ..operators.cleaning import parse_messages
from ..schemas import KEYS, TRANSACTION_MESSAGE, WEB_EVENT_MESSAGE
from .adaptive import adaptive

INTERVAL = "10 seconds"
SCHEMAS = {"sales": TRANSACTION_MESSAGE, "events": WEB_EVENT_MESSAGE}


@dataclass(frozen=True)
class Metric:
    topic: str
    columns: tuple
    totals: Callable
    shape: str = "list"
    finish: Callable = staticmethod(lambda totals: totals)


METRICS = {
    "global_kpis": Metric("sales", ("id_pedido", "valor_total_compra"), kpis.global_kpis, "object"),
    "category_revenue": Metric("sales", ("categoria", "valor_total_compra"), kpis.category_revenue),
    "top_items": Metric("sales", ("item",), kpis.item_counts, finish=kpis.top_items),
    "carts_created": Metric("events", ("tipo_evento",), kpis.carts_created, "object"),
    "carts_converted": Metric("sales", ("id_carrinho",), kpis.carts_converted, "object"),
}


def start_metric(name, messages, store, checkpoints, **trigger):
    """One query over a message stream, with its own checkpoint; only its columns are decoded.

    ``trigger`` defaults to a 10 second interval.
    """
    metric = METRICS[name]
    parsed = parse_messages(messages, SCHEMAS[metric.topic], metric.columns)

    def publish(totals, batch_id):
        with adaptive(totals):
            store.publish(metric.finish(totals), KEYS[name], metric.shape)

    return (
        metric.totals(parsed).writeStream.queryName(f"realtime_{name}").outputMode("complete")
        .foreachBatch(publish).option("checkpointLocation", f"{checkpoints}/{name}")
        .trigger(**(trigger or {"processingTime": INTERVAL})).start()
    )


def start_all(sales_messages, event_messages, store, checkpoints, **trigger):
    topics = {"sales": sales_messages, "events": event_messages}
    return [
        start_metric(name, topics[m.topic], store, checkpoints, **trigger)
        for name, m in METRICS.items()
    ]


def await_all(queries):
    """Wait until all have ended; the first that fails raises its error, whatever the others do."""
    waiting = list(queries)
    while waiting:
        for query in waiting:
            query.awaitTermination(1)
        waiting = [query for query in waiting if query.isActive]
