"""Edge cases of the batch metrics on a handful of rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidecart.functions import expressions
from tidecart.operators import carts, cleaning, kpis, periods, products, revenue, upsert
from tidecart.schemas import CART_CREATED, GOLD, TRANSACTION_MESSAGE

SALES = ("id_transacao long, id_pedido string, id_usuario long, id_produto long, "
         "quantidade_produto int, valor_total_compra double, data_compra timestamp, id_carrinho string")


def day(text):
    return dt.datetime.fromisoformat(text)


def sales(spark, *rows):
    """Rows of (user, product, units, value, time[, cart])."""
    full = [(i, f"p{i}", u, p, n, v, day(t), (rest[0] if rest else None))
            for i, (u, p, n, v, t, *rest) in enumerate(rows)]
    return spark.createDataFrame(full, SALES)


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([(1, "A"), (2, "B")], "id_usuario long, segmento_cliente string")


def growth_by_day(frame):
    return {(r["data"].isoformat(), r["segmento_cliente"]): r[revenue.GROWTH] for r in frame.collect()}


def test_day_gap(spark, customers):
    daily = revenue.daily_revenue(
        sales(spark, (1, 1, 1, 100.0, "2024-05-01"), (1, 1, 1, 150.0, "2024-05-03")), customers
    )
    assert growth_by_day(revenue.growth_since_last_sale_day(daily))["2024-05-03", "A"] == 0.5
    assert growth_by_day(revenue.growth_since_yesterday(daily))["2024-05-03", "A"] is None


def test_zero_revenue_before(spark, customers):
    daily = revenue.daily_revenue(
        sales(spark, (1, 1, 1, 0.0, "2024-05-01"), (1, 1, 1, 50.0, "2024-05-02")), customers
    )
    assert growth_by_day(revenue.growth_since_last_sale_day(daily))["2024-05-02", "A"] is None


def test_unknown_user_keeps_its_sale(spark, customers):
    rows = revenue.daily_revenue(sales(spark, (9, 1, 1, 10.0, "2024-05-01")), customers).collect()
    assert [(r.segmento_cliente, r.receita_total_diaria, r.numero_de_pedidos) for r in rows] == [(None, 10.0, 1)]


def test_join_yesterday_matches_window(spark, customers):
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, 9]), 1, 1, rng.randrange(100, 99999) / 100,
             f"2024-0{rng.randint(1, 3)}-{rng.randint(1, 28):02d}") for _ in range(300)]
    daily = revenue.daily_revenue(sales(spark, *rows), customers)
    assert growth_by_day(revenue.growth_since_yesterday(daily)) == growth_by_day(
        revenue.join_yesterday(daily, daily)
    )


def test_hot_user_gives_the_same_totals_however_joined(spark, customers):
    rows = [(1 if i % 3 else 2, 1, 1, i / 100, f"2024-05-{1 + i % 5:02d}") for i in range(500)]
    small = revenue.daily_revenue(sales(spark, *rows), customers)
    expected = {tuple(r) for r in small.collect()}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = revenue.daily_revenue(sales(spark, *rows), customers)
        assert {tuple(r) for r in large.collect()} == expected
        halves = [revenue.daily_revenue(sales(spark, *rows[a::2]), customers) for a in (0, 1)]
        assert {tuple(r) for r in revenue.added(*halves).select(small.columns).collect()} == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_amounts_are_summed_unrounded_and_bad_ones_refused(spark):
    total = lambda *v: spark.createDataFrame([(x,) for x in v], "x double").agg(expressions.total("x")).first()[0]
    assert total(*[0.333] * 1000) == 333.0
    assert total(0.005, -0.005) == 0.0 and total(-0.005) == -0.005
    for bad in (float("nan"), float("inf"), 1e15):
        with pytest.raises(Exception):
            total(bad)


def test_sums_beyond_64_bits_are_exact(spark):
    """In millionths 64 bits hold 9.2 million millions; what all sales add up to may be more."""
    total = lambda *v: spark.createDataFrame([(x,) for x in v], "x double").agg(expressions.total("x")).first()[0]
    assert total(*[9e12] * 3) == 2.7e13 and total(*[-9e12] * 3) == -2.7e13
    assert total(9e12, 9e12, -9e12, -9e12, 0.000001, None) == 0.000001
    assert total(9e12, 9e12, 0.25, -0.75) == 17999999999999.5
    assert total(None) is None
    frame = sales(spark, *[(u, 1, 1, 9e12, "2024-05-01") for u in (1, 2, 3)])
    for exact in (True, False):
        assert tuple(kpis.global_kpis(frame, exact).first()) == (2.7e13, 3, 9e12)
    assert tuple(periods.revenue_per_user(frame).first()) == (3, 9e12)


def test_facts_are_summed_before_a_large_dimension_is_joined(spark, customers):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = revenue.daily_revenue(sales(spark, (1, 1, 1, 1.0, "2024-05-01")), customers)
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    join = plan.index("SortMergeJoin")
    assert "partial_sum" in plan[join:] and "BroadcastHashJoin" not in plan


def test_trailing_days(spark, customers):
    daily = revenue.daily_revenue(
        sales(spark, (1, 1, 1, 1.0, "2024-05-01"), (1, 1, 1, 2.0, "2024-05-31"),
              (1, 1, 1, 3.0, "2024-04-30")), customers
    )
    kept = revenue.trailing_days(daily, 30, F.lit(dt.date(2024, 5, 31)))
    assert {r.receita_total_diaria for r in kept.collect()} == {1.0, 2.0}


def test_tie_at_rank_ten(spark):
    rows = [(1, p, 20 - p if p < 10 else 5, 1.0, "2024-02-01") for p in range(1, 12)]
    ranked = products.rank_in_quarter(products.units_by_quarter(sales(spark, *rows))).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(1, 11))
    assert 11 not in {r.id_produto for r in ranked}


def test_ranking_is_cut_before_the_shuffle(spark):
    ranked = products.rank_in_quarter(products.units_by_quarter(sales(spark, (1, 1, 1, 1.0, "2024-02-01"))))
    assert "WindowGroupLimit" in ranked._jdf.queryExecution().executedPlan().toString()


def test_quarter_boundary(spark):
    units = products.units_by_quarter(
        sales(spark, (1, 1, 2, 1.0, "2023-12-31T23:59:59"), (1, 1, 3, 1.0, "2024-01-01T00:00:00"))
    )
    assert {(r.ano, r.trimestre, r.unidades_vendidas) for r in units.collect()} == {(2023, 4, 2), (2024, 1, 3)}


@pytest.mark.parametrize("newest, first, last", [
    ("2024-02-10", (2023, 1), (2023, 4)),
    ("2024-09-30T23:00:00", (2023, 3), (2024, 2)),
    ("2024-10-01", (2023, 4), (2024, 3)),
])
def test_last_complete_quarters(spark, newest, first, last):
    rows = [(1, 1, 1, 1.0, f"{y}-{m:02d}-15") for y in (2022, 2023, 2024) for m in range(1, 13)]
    rows = [r for r in rows if r[4] < newest] + [(1, 1, 1, 1.0, newest)]
    kept = products.available_quarters(
        products.touched_quarters(products.last_complete_quarters(sales(spark, *rows)))
    ).collect()
    assert len(kept) == 4
    assert (tuple(kept[0]), tuple(kept[-1])) == (first, last)


def test_slice_defaults_to_the_latest_quarter(spark):
    rows = [(1, 1, 1, 1.0, t) for t in ("2023-11-01", "2024-01-01", "2024-05-01")]
    ranked = products.rank_in_quarter(products.units_by_quarter(sales(spark, *rows)))
    assert [(r.ano, r.trimestre) for r in products.quarter_slice(ranked).collect()] == [(2024, 2)]
    assert [(r.ano, r.trimestre) for r in products.quarter_slice(ranked, 2023).collect()] == [(2023, 4)]
    assert products.quarter_slice(ranked, 2023, 1).count() == 0


def test_no_sales_at_all(spark, customers):
    none = sales(spark).limit(0)
    events = spark.createDataFrame([], "id_carrinho string, tipo_evento string")
    assert revenue.growth_since_last_sale_day(revenue.daily_revenue(none, customers)).count() == 0
    assert products.rank_in_quarter(
        products.units_by_quarter(products.last_complete_quarters(none))).count() == 0
    assert carts.abandonment_rate(events, none).first().taxa_abandono == 0
    row = kpis.global_kpis(none).first()
    assert (row.receita_total_global, row.pedidos_totais_global, row.ticket_medio_global) == (None, 0, None)
    assert kpis.conversion_rates(kpis.carts_created(events), kpis.carts_converted(none)).first().taxa_abandono == 0


def test_ticket_without_order_ids(spark):
    frame = sales(spark, (1, 1, 1, 5.0, "2024-05-01")).withColumn("id_pedido", F.lit(None).cast("string"))
    for exact in (True, False):
        row = kpis.global_kpis(frame, exact).first()
        assert (row.receita_total_global, row.ticket_medio_global) == (5.0, None)


def test_approximate_orders_are_close(spark):
    frame = spark.range(20000).select(
        F.col("id").cast("string").alias("id_pedido"), F.lit(1.0).alias("valor_total_compra"))
    orders = kpis.global_kpis(frame).first().pedidos_totais_global
    assert abs(orders - 20000) / 20000 < 0.15


def test_amounts_sum_exactly(spark):
    frame = spark.range(100000).select(F.lit(0.1).alias("valor_total_compra"), F.lit("a").alias("id_pedido"))
    assert kpis.global_kpis(frame, exact=True).first().receita_total_global == 10000.0


def events_of(spark, *rows):
    return spark.createDataFrame(list(rows), "id_carrinho string, tipo_evento string")


def test_abandonment(spark):
    events = events_of(spark, ("c1", CART_CREATED), ("c1", CART_CREATED), ("c2", CART_CREATED),
                       (None, CART_CREATED), ("c3", "login"))
    sold = sales(spark, (1, 1, 1, 1.0, "2024-05-01", "c1"), (1, 1, 1, 1.0, "2024-05-01", "c9"),
                 (1, 1, 1, 1.0, "2024-05-01", None))
    row = carts.abandonment_rate(events, sold).first()
    # c9 was never created, a cart without id is never matched, c1 counts once.
    assert (row.carrinhos_criados, row.carrinhos_abandonados) == (3, 2)
    assert row.taxa_abandono == pytest.approx(200 / 3)
    assert kpis.carts_created(events).first().total == 4
    left = carts.abandoned_carts(carts.created_carts(events), carts.finished_carts(sold))
    assert {r.id_carrinho for r in left.collect()} == {"c2", None}


def test_conversion_can_exceed_one_hundred(spark):
    made = spark.createDataFrame([(2,)], "total long")
    sold = spark.createDataFrame([(3,)], "total long")
    row = kpis.conversion_rates(made, sold).first()
    assert (row.taxa_conversao, row.taxa_abandono) == (150.0, -50.0)


def test_item_counts_are_rows_and_ties_go_by_name(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "item string")
    assert [tuple(r) for r in kpis.top_items(kpis.item_counts(frame), 2).collect()] == [("c", 2), ("a", 1)]


def test_periods(spark, customers):
    frame = sales(spark, (1, 1, 1, 10.0, "2024-01-31"), (1, 1, 1, 30.0, "2024-03-01"),
                  (2, 1, 1, 20.0, "2024-03-02"))
    tickets = periods.ticket_variation(periods.ticket_per_period(frame)).orderBy("periodo").collect()
    assert [(r.ticket_medio, r.variacao_ticket) for r in tickets] == [(10.0, None), (25.0, 1.5)]
    assert periods.revenue_per_user(frame).first().receita_media == 30.0
    more = customers.union(spark.createDataFrame([(3, "B")], customers.schema))
    assert periods.orders_per_customer(frame, more).first().pedidos_por_cliente == 1.0


def test_malformed_messages(spark):
    texts = spark.createDataFrame([
        ('{"id_pedido": "a", "id_usuario": "x", "valor_total_compra": 1.5}',),
        ("not json",), ("{}",), (None,), ('{"id_pedido": "b", "valor',), ('{"outro": 1}',),
    ], "value string")
    good = cleaning.parse_messages(texts, TRANSACTION_MESSAGE)
    assert good.columns == TRANSACTION_MESSAGE.fieldNames()
    assert {(r.id_pedido, r.id_usuario, r.valor_total_compra) for r in good.collect()} == {
        ("a", None, 1.5), (None, None, None)}
    assert cleaning.rejected_messages(texts, TRANSACTION_MESSAGE).count() == 4
    # Decoding fewer columns does not change which messages count.
    assert cleaning.parse_messages(texts, TRANSACTION_MESSAGE, ["item"]).count() == 2


def test_cleaning_tolerates_bad_values(spark):
    raw = spark.createDataFrame([(1, "x", "1.5", "7"), (2, "y", "?", "8")],
                                "id_produto long, nome_produto string, preco_unitario string, estoque_disponivel string")
    raw = raw.withColumns({"descricao_produto": F.lit(""), "categoria": F.lit("")})
    assert [r.preco_unitario for r in cleaning.clean_products(raw).orderBy("id_produto").collect()] == [1.5, None]
    assert tuple(cleaning.rejected(raw, "catalogo_produtos").first()) == (1, 0)


def test_upserts_match_null_keys(spark):
    schema = "data date, segmento_cliente string, receita double"
    d = dt.date(2024, 5, 1)
    old = spark.createDataFrame([(d, None, 1.0), (d, "A", 2.0)], schema)
    new = spark.createDataFrame([(d, None, 5.0), (d, "it's", 3.0)], schema)
    keys = ["data", "segmento_cliente"]
    rows = lambda df: {tuple(r)[1:] for r in df.collect()}
    assert rows(upsert.upsert_replace(old, new, keys)) == {(None, 5.0), ("A", 2.0), ("it's", 3.0)}
    assert rows(upsert.upsert_add(old, new, keys, ["receita"])) == {(None, 6.0), ("A", 2.0), ("it's", 3.0)}
    assert rows(upsert.insert_if_absent(old, new, keys)) == {(None, 1.0), ("A", 2.0), ("it's", 3.0)}


def test_gold_schemas():
    assert GOLD["receita_diaria"].fieldNames()[-1] == revenue.GROWTH
