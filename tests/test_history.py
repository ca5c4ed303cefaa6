"""The batch pipeline: rerunnable, cut off at a date, published under the registered keys."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidecart.plans import history
from tidecart.plans.staging import new_folder
from tidecart.schemas import CART_CREATED, KEYS
from tidecart.sources.snapshots import SnapshotStore

SALES = ("id_transacao long, id_usuario long, id_produto long, quantidade_produto int, "
         "valor_total_compra double, data_compra timestamp, id_carrinho string")


@pytest.fixture
def inputs(spark):
    days = [dt.datetime(2023, 11, 1), dt.datetime(2023, 11, 2), dt.datetime(2024, 2, 1), dt.datetime(2024, 4, 2)]
    sales = spark.createDataFrame(
        [(i, 1, 7, 2, 10.0 * (i + 1), day, f"c{i}") for i, day in enumerate(days)], SALES)
    customers = spark.createDataFrame([(1, "A")], "id_usuario long, segmento_cliente string")
    events = spark.createDataFrame(
        [(f"c{i}", CART_CREATED, day) for i, day in enumerate(days + days)],
        "id_carrinho string, tipo_evento string, timestamp_evento timestamp")
    return sales, customers, events


def test_recompute_and_rerun(spark, inputs):
    root, store = new_folder(spark, "gold"), SnapshotStore(new_folder(spark, "snapshots"))
    payload = lambda key: json.loads(store.fetch(spark, KEYS[key]).first().payload)
    for _ in range(2):
        history.recompute(*inputs, root, store)
    assert [r["data"] for r in payload("batch_growth")] == ["2024-04-02", "2024-02-01", "2023-11-02", "2023-11-01"]
    assert [r["crescimento_receita_d-1"] for r in payload("batch_growth")][-2:] == [1.0, None]
    # The quarter of the newest sale is not complete.
    assert [(r["ano"], r["trimestre"], r["unidades_vendidas"]) for r in payload("batch_top_products")] == [
        (2024, 1, 2), (2023, 4, 4)]
    assert payload("batch_abandonment") == 50.0

    history.recompute(*inputs, root, store, as_of=F.lit(dt.datetime(2024, 4, 1)))
    assert [r["data"] for r in payload("batch_growth")][0] == "2024-02-01"
    assert [(r["ano"], r["trimestre"]) for r in payload("batch_top_products")] == [(2023, 4)]


def test_nothing_to_publish_is_an_error(spark, inputs):
    sales, customers, events = inputs
    store = SnapshotStore(new_folder(spark, "snapshots"))
    with pytest.raises(ValueError):
        history.recompute(sales.limit(0), customers, events, new_folder(spark, "gold"), store)
