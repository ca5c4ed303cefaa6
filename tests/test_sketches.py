"""Day sketches against sketches in one pass and exact counts, in batch and as a stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidecart.operators import sketches
from tidecart.plans import queries
from tidecart.plans.staging import new_folder
from tidecart.sources import tables
from tidecart.streaming.sketched import SketchedDays

FOLDER = "/root/testdata/sf0.001"
START = {"day": "day", "week": "week", "month": "month", "quarter": "quarter", "year": "year"}


def in_one_pass(sales):
    """Sketches over the sales of each period themselves, counted as united ones are."""
    out = {}
    for period in [*sketches.PERIODS, "all"]:
        start = F.lit(None).cast("date") if period == "all" else F.date_trunc(period, "data_compra").cast("date")
        once = sales.groupBy(start.alias("inicio")).agg(*[
            F.hll_sketch_agg(F.col(c).cast("string"), F.lit(sketches.PRECISION)).alias(c) for c in ("id_pedido", "id_carrinho")],
            F.count_distinct("id_pedido").alias("exact"), F.count(F.lit(1)).alias("linhas"))
        once = once.select("inicio", "exact", "linhas", *[F.hll_sketch_estimate(F.hll_union(c, c)).alias(c) for c in ("id_pedido", "id_carrinho")])
        out.update({(period, r.inicio): r for r in once.collect()})
    return out


@pytest.mark.parametrize("name", ["sketched_periods", "stream_sketched_periods"])
def test_united_days_equal_one_pass(spark, name):
    once = in_one_pass(tables.sales(spark, FOLDER, "id_pedido", "id_carrinho", "data_compra"))
    found = queries.QUERIES[name](spark, FOLDER).collect()
    assert len(found) == len(once)
    for r in found:
        expected = once[r.periodo, r.inicio]
        assert (r.numero_pedidos, r.carrinhos, r.linhas) == (expected.id_pedido, expected.id_carrinho, expected.linhas)
        assert abs(r.numero_pedidos - expected.exact) <= max(1, 0.06 * expected.exact)
        assert r.ticket_medio == r.vendas_totais / r.numero_pedidos


def test_revenue_of_all_days_may_pass_64_bits_of_millionths(spark):
    schema = "id_pedido string, id_carrinho string, valor_total_compra double, data_compra timestamp"
    days = SketchedDays(new_folder(spark, "sketches"))
    for batch in range(3):
        days.add(spark.createDataFrame([(f"p{batch}", "c", 6e12, dt.datetime(2024, 5, 1 + batch))], schema), batch)
    assert days.read(spark).schema["unidades"].dataType.simpleString() == "bigint"
    found = {(r.periodo, r.inicio): r.vendas_totais for r in sketches.all_periods(days.read(spark)).collect()}
    assert found["all", None] == found["month", dt.date(2024, 5, 1)] == 1.8e13
    assert found["day", dt.date(2024, 5, 2)] == 6e12


def test_repeated_batches_and_rows_change_no_count(spark):
    schema = "id_pedido string, id_carrinho string, valor_total_compra double, data_compra timestamp"
    days = SketchedDays(new_folder(spark, "sketches"))
    rows = [(f"p{i % 40}", f"c{i % 7}", 1.0, dt.datetime(2024, 5, 1 + i % 3)) for i in range(120)]
    counted = lambda: {(r.periodo, r.inicio): (r.numero_pedidos, r.carrinhos) for r in sketches.all_periods(days.read(spark)).collect()}
    assert counted() == {("all", None): (0, 0)} or counted()[("all", None)][0] in (0, None)
    days.add(spark.createDataFrame(rows, schema), 0)
    first = counted()
    assert first["all", None] == (40, 7) and first["month", dt.date(2024, 5, 1)] == (40, 7)
    for _ in range(2):
        days.add(spark.createDataFrame(rows[:50] + [("new", None, 2.0, dt.datetime(2024, 6, 1))], schema), 1)
    later = counted()
    assert later["all", None] == (41, 7) and later["month", dt.date(2024, 5, 1)] == (40, 7)
    assert later["day", dt.date(2024, 6, 1)] == (1, 0)
