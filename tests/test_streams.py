"""Streams over small message and bronze folders: micro-batches, replays, late rows."""

import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidecart.operators import carts, products, revenue
from tidecart.plans import staging
from tidecart.plans.staging import new_folder
from tidecart.schemas import CART_CREATED, GOLD, KEYS, TRANSACTION_MESSAGE
from tidecart.sources import lake, messages
from tidecart.sources.snapshots import SnapshotStore
from tidecart.streaming import persist, realtime, windowed
from tidecart.streaming.historical import HistoricalMetrics

ALL = {"availableNow": True}
SALES = ("id_transacao long, id_pedido string, id_usuario long, id_produto long, "
         "quantidade_produto int, valor_total_compra double, data_compra timestamp, id_carrinho string")


def day(text):
    return dt.datetime.fromisoformat(text)


def sale(n, user, product, units, value, time, cart=None):
    return n, f"p{n}", user, product, units, value, day(time), cart


@pytest.fixture
def metrics(spark):
    customers = spark.createDataFrame([(1, "A"), (2, "B")], "id_usuario long, segmento_cliente string")
    catalog = spark.createDataFrame([(p, f"produto {p}") for p in range(1, 30)], "id_produto long, nome_produto string")
    return HistoricalMetrics(new_folder(spark, "gold"), SnapshotStore(new_folder(spark, "snapshots")),
                             customers, catalog, as_of=F.lit(dt.date(2024, 6, 1)), buckets=4)


def totals(spark, metrics, *rows):
    return revenue.daily_revenue(spark.createDataFrame(list(rows), SALES), metrics.customers)


def daily(spark, metrics):
    return {(r["data"].isoformat(), r.segmento_cliente): (r.receita_total_diaria, r[revenue.GROWTH])
            for r in metrics.gold["receita_diaria"].read(spark).collect()}


def test_growth_within_one_batch_and_after_a_late_day(spark, metrics):
    first, second = sale(1, 1, 1, 1, 100.0, "2023-12-31"), sale(2, 1, 1, 1, 150.0, "2024-01-01")
    metrics.daily_revenue(totals(spark, metrics, first, second), 0)
    assert daily(spark, metrics)["2024-01-01", "A"] == (150.0, 0.5)
    # A late sale changes the last day of the year before, in another unit.
    late = sale(3, 1, 1, 1, 200.0, "2023-12-31")
    for _ in range(2):
        metrics.daily_revenue(totals(spark, metrics, first, late), 1)
    assert daily(spark, metrics)["2024-01-01", "A"] == (150.0, -0.5)


def test_null_segment_stays_one_row(spark, metrics):
    unknown = sale(1, 9, 1, 1, 10.0, "2024-05-01")
    metrics.daily_revenue(totals(spark, metrics, unknown), 0)
    metrics.daily_revenue(totals(spark, metrics, unknown, sale(2, 9, 1, 1, 5.0, "2024-05-01")), 1)
    assert daily(spark, metrics) == {("2024-05-01", None): (15.0, None)}


def test_snapshot_covers_the_last_thirty_days(spark, metrics):
    metrics.daily_revenue(totals(spark, metrics, sale(1, 1, 1, 1, 1.0, "2024-04-01"),
                                 sale(2, 1, 1, 1, 2.0, "2024-05-30"), sale(3, 2, 1, 1, 3.0, "2024-05-31")), 0)
    page = metrics.store.fetch(spark, KEYS["daily_revenue"]).first()
    assert [r["data"] for r in json.loads(page.payload)] == ["2024-05-31", "2024-05-30"]


def ranking(spark, metrics):
    return [(r["rank"], r.id_produto, r.nome_produto, r.unidades_vendidas) for r in
            products.newest_quarters_first(metrics.gold["produtos_top10_trimestral"].read(spark)).collect()]


def test_no_stale_rank_and_no_double_count(spark, metrics):
    first = spark.createDataFrame([sale(p, 1, p, 20 - p, 1.0, "2024-02-01") for p in range(1, 11)], SALES)
    metrics.top_products(first, 0)
    assert [r[1] for r in ranking(spark, metrics)] == list(range(1, 11))
    second = spark.createDataFrame([sale(20, 1, 11, 50, 1.0, "2024-03-01")], SALES)
    for _ in range(2):
        metrics.top_products(second, 1)
    ranked = ranking(spark, metrics)
    assert [r[0] for r in ranked] == list(range(1, 11))
    assert ranked[0] == (1, 11, "produto 11", 50) and 10 not in {r[1] for r in ranked}
    assert sum(r.unidades_vendidas for r in metrics.gold["produtos_agregados_trimestral"].read(spark).collect()) \
        == sum(20 - p for p in range(1, 11)) + 50


def test_totals_are_summed_once_for_the_quarters_that_a_batch_stored(spark, metrics):
    table, summed = metrics.gold["produtos_agregados_trimestral"], spark.sparkContext.accumulator(0)

    def counted(df):
        def tell(batches):
            for batch in batches:
                summed.add(batch.num_rows)
                yield batch
        folded = table.fold(df)
        return folded.mapInArrow(tell, folded.schema)

    metrics.gold[table.path.rsplit("/", 1)[-1]] = replace(table, fold=counted)
    days = ["2023-11-01", "2024-02-01", "2024-02-02", "2024-03-01"]
    metrics.top_products(spark.createDataFrame([sale(i, 1, 1 + i % 3, 1, 1.0, day) for i, day in enumerate(days)], SALES), 0)
    assert summed.value == 4 and table.units_written(spark, 0) == {"2023T4", "2024T1"}
    # A batch of another quarter reads that one only; sales without a date are stored and not ranked.
    late = [sale(9, 1, 5, 1, 1.0, "2024-05-01"), (10, "p10", 1, 5, 7, 1.0, None, None)]
    metrics.top_products(spark.createDataFrame(late, SALES), 1)
    assert summed.value == 5 and table.units_written(spark, 1) == {"2024T2"}
    assert sum(r.unidades_vendidas for r in table.read(spark).collect()) == 12
    ranked = metrics.gold["produtos_top10_trimestral"].read(spark).collect()
    assert sorted((r.ano, r.trimestre, r.id_produto) for r in ranked) == [
        (2023, 4, 1), (2024, 1, 1), (2024, 1, 2), (2024, 1, 3), (2024, 2, 5)]


def marks(spark, created, finished):
    ids = lambda names: spark.createDataFrame([(n,) for n in names], "id_carrinho string")
    return carts.mark(ids(created), True).unionByName(carts.mark(ids(finished), False))


def published_rate(spark, metrics):
    return metrics.store.rows(spark, KEYS["abandonment"], "value string").first().value


def test_abandonment_follows_either_side(spark, metrics):
    metrics.carts(marks(spark, ["a", "b", "b", "c", None], ["x"]), 0)
    assert published_rate(spark, metrics) == "100.00"
    for _ in range(2):
        metrics.carts(marks(spark, ["a"], ["a", "b", "a"]), 1)
    assert published_rate(spark, metrics) == "50.00"
    # x was finished before it was created; both tables hold each id once.
    metrics.carts(marks(spark, ["x"], []), 2)
    assert published_rate(spark, metrics) == "40.00"
    ids = lambda t: sorted(str(r[0]) for r in metrics.gold[t].read(spark).collect())
    assert ids("carrinhos_criados") == ["None", "a", "b", "c", "x"]
    assert ids("carrinhos_finalizados") == ["a", "b", "x"]


def test_empty_batches_change_nothing(spark, metrics):
    none = spark.createDataFrame([], SALES)
    metrics.daily_revenue(revenue.daily_revenue(none, metrics.customers), 0)
    metrics.top_products(none, 0)
    metrics.carts(marks(spark, ["a"], []).limit(0), 0)
    assert all(t.versions(spark) == [] for t in metrics.gold.values())


def test_many_batches_with_compaction_equal_one_batch(spark, metrics):
    metrics.compact_every = 2
    created = [f"c{i % 40}" for i in range(120)]
    finished = [f"c{i}" for i in range(0, 60, 3)]
    sold = [sale(i, 1 + i % 3, 1 + i % 15, 1 + i % 4, i / 4, f"2024-0{1 + i % 5}-10") for i in range(120)]
    for batch in range(6):
        part = slice(batch * 20, batch * 20 + 20)
        metrics.carts(marks(spark, created[part] or [None], finished[batch * 4:batch * 4 + 4] or ["c0"]), batch)
        metrics.top_products(spark.createDataFrame(sold[part], SALES), batch)
    whole = products.with_product_names(
        products.rank_in_quarter(products.units_by_quarter(spark.createDataFrame(sold, SALES))), metrics.catalog)
    assert sorted(map(tuple, metrics.gold["produtos_top10_trimestral"].read(spark).collect())) \
        == sorted(map(tuple, whole.collect()))
    share = 100 * (40 - len(set(created) & set(finished))) / 40
    assert published_rate(spark, metrics) == f"{share:.2f}"
    assert len(metrics.counters.versions(spark)) < 6


def test_stream_of_bronze_files_equals_batch(spark, metrics):
    path, checkpoints = new_folder(spark, "bronze"), new_folder(spark, "checkpoint")
    rows = [sale(i, 1 + i % 3, 1 + i % 12, 1, i / 100, f"2024-05-{1 + i % 9:02d}", f"c{i}") for i in range(90)]
    frame = spark.createDataFrame(rows, SALES)
    schema = frame.schema

    def stream():
        return lake.stream_table(spark, path, schema, files_per_batch=1)

    # Two loads, the second after a stop and restart from the checkpoint.
    for part in (frame.filter("id_transacao < 50"), frame.filter("id_transacao >= 50")):
        lake.append(part.coalesce(2), path)
        events = stream().select("id_carrinho", F.lit(CART_CREATED).alias("tipo_evento"))
        for query in metrics.start_all(stream(), events, checkpoints, **ALL):
            query.awaitTermination()
    want = revenue.growth_since_yesterday(revenue.daily_revenue(frame, metrics.customers))
    got = metrics.gold["receita_diaria"].read(spark)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    assert metrics.gold["produtos_agregados_trimestral"].read(spark).agg(F.sum("unidades_vendidas")).first()[0] == 90
    assert published_rate(spark, metrics) == "0.00"


def message_folder(spark, *texts):
    path = new_folder(spark, "messages")
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.parquet(path)
    return path


def sale_text(n, item="a", value=2.5):
    return json.dumps({"id_pedido": f"p{n}", "item": item, "categoria": "x", "valor_total_compra": value,
                       "id_carrinho": f"c{n}", "data_compra": "2024-05-03T10:15:00", "nome_usuario": "Ana"})


def test_realtime_snapshots(spark):
    sold = message_folder(spark, *[sale_text(n, "ab"[n % 2]) for n in range(5)], "not json")
    seen = message_folder(spark, *['{"tipo_evento": "carrinho_criado", "id_carrinho": "c1"}'] * 2, '{"tipo_evento": "login"}')
    store = SnapshotStore(new_folder(spark, "snapshots"))
    queries = realtime.start_all(messages.folder_stream(spark, sold), messages.folder_stream(spark, seen),
                                 store, new_folder(spark, "checkpoint"), **ALL)
    realtime.await_all(queries)
    payload = lambda key: json.loads(store.fetch(spark, KEYS[key]).first().payload)
    assert payload("global_kpis") == {
        "receita_total_global": 12.5, "pedidos_totais_global": 5, "ticket_medio_global": 2.5}
    assert payload("category_revenue") == [{"categoria": "x", "receita": 12.5}]
    assert payload("top_items") == [{"item": "a", "total_vendido": 3}, {"item": "b", "total_vendido": 2}]
    assert payload("carts_created") == {"total": 2}
    assert payload("carts_converted") == {"total": 5}


def test_streamed_revenue_may_pass_64_bits_of_millionths(spark):
    """The sum passes them in the second of three batches, from what is stored of the first."""
    path, store = new_folder(spark, "messages"), SnapshotStore(new_folder(spark, "snapshots"))
    texts = spark.createDataFrame([(sale_text(n, value=5e12 + n),) for n in range(3)], "value string")
    texts.repartition(3).write.option("maxRecordsPerFile", 1).parquet(path)
    source = messages.folder_stream(spark, path, files_per_batch=1)
    for name in ("global_kpis", "category_revenue"):
        realtime.start_metric(name, source, store, new_folder(spark, "checkpoint"), **ALL).awaitTermination()
    payload = lambda key: json.loads(store.fetch(spark, KEYS[key]).first().payload)
    assert payload("global_kpis") == {
        "receita_total_global": 15000000000003.0, "pedidos_totais_global": 3, "ticket_medio_global": 5000000000001.0}
    assert payload("category_revenue") == [{"categoria": "x", "receita": 15000000000003.0}]


def test_persist_drops_labels_and_survives_a_replay(spark):
    source = message_folder(spark, *[sale_text(n) for n in range(3)], "not json")
    path, checkpoints = new_folder(spark, "stored"), new_folder(spark, "checkpoint")
    stream = messages.folder_stream(spark, source)
    persist.start_persist(stream, "transacoes_vendas", path, checkpoints, **ALL).awaitTermination()
    stored = persist.persisted(spark, path, "transacoes_vendas")
    assert stored.count() == 3 and "nome_usuario" not in stored.columns
    batch = persist.table_rows(spark.read.parquet(source), "transacoes_vendas")
    persist.write_batch(path, batch, 0)
    assert persist.persisted(spark, path, "transacoes_vendas").count() == 3
    assert persist.persisted(spark, new_folder(spark, "nothing"), "eventos_web").count() == 0


def test_late_rows_are_kept_and_counted(spark):
    path, checkpoints = new_folder(spark, "bronze"), new_folder(spark, "checkpoint")
    schema = "data_compra timestamp, valor_total_compra double"
    metric = windowed.WindowedSales(new_folder(spark, "windows"), schema, delay=dt.timedelta(days=1))

    def run(*rows):
        lake.append(spark.createDataFrame([(day(t) if t else None, v) for t, v in rows], schema).coalesce(1), path)
        metric.start(lake.stream_table(spark, path, schema), checkpoints, **ALL).awaitTermination()
        return sorted(r.valor_total_compra for r in metric.late_rows(spark).collect())

    shown = lambda frame: {(r.inicio.date().isoformat(), r.vendas_totais, r.linhas) for r in frame.collect()}
    assert run(("2024-05-01T10:00:00", 1.0), ("2024-05-03T01:00:00", 2.0)) == []
    # The clock stands at 2 May 01:00: the first of May is final, the second is not.
    assert run(("2024-05-01T11:00:00", 4.0), ("2024-05-02T12:00:00", 8.0), ("2024-05-06T00:00:00", 1.0), (None, 32.0)) == [4.0, 32.0]
    assert shown(metric.final(spark)) == {("2024-05-01", 1.0, 1), ("2024-05-02", 8.0, 1), ("2024-05-03", 2.0, 1)}
    assert shown(metric.open(spark)) == {("2024-05-06", 1.0, 1)}
    # The day that was final a batch ago, by a query that was restarted.
    assert run(("2024-05-04T23:59:59.999999", 16.0)) == [4.0, 16.0, 32.0]


def test_engine_watermark_windows(spark):
    path, out = new_folder(spark, "bronze"), new_folder(spark, "windows")
    schema = "data_compra timestamp, valor_total_compra double"
    checkpoints = new_folder(spark, "checkpoint")
    for rows in ([("2024-05-01T10:00:00", 1.0), ("2024-05-03T01:00:00", 2.0)],
                 [("2024-05-01T11:00:00", 4.0), ("2024-05-02T12:00:00", 8.0), ("2024-05-06T00:00:00", 1.0)]):
        lake.append(spark.createDataFrame([(day(t), v) for t, v in rows], schema).coalesce(1), path)
        windowed.windowed_sales(lake.stream_table(spark, path, schema), delay="1 day").writeStream.format(
            "parquet").option("path", out).option("checkpointLocation", checkpoints).trigger(**ALL).start().awaitTermination()
    got = {(r.inicio.date().isoformat(), r.vendas_totais) for r in spark.read.parquet(out).collect()}
    assert got == {("2024-05-01", 1.0), ("2024-05-02", 8.0), ("2024-05-03", 2.0)}


def test_message_schema_has_the_cart(spark):
    assert "id_carrinho" in TRANSACTION_MESSAGE.fieldNames() and len(GOLD) == 5


@pytest.mark.parametrize("stage", ["event_messages", "bronze_events", "events_by_time", "sales_messages", "bronze_sales"])
def test_staged_inputs_take_three_batches(spark, stage):
    staged = getattr(staging, stage)(spark, "/root/testdata/sf0.001")
    path, checkpoint = new_folder(spark, "copy"), new_folder(spark, "checkpoint")
    query = staging.follow(spark, staged).writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) >= 3
    assert spark.read.parquet(path).count() == spark.read.parquet(staged).count()
