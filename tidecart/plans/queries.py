"""Every registered query: (spark, folder) -> DataFrame over the tables of that folder."""

from datetime import date

from pyspark.sql import functions as F

from ..operators import carts, cleaning, kpis, periods, products, revenue, sketches, upsert
from ..schemas import CART_CREATED, GOLD, KEYS, TRANSACTION_MESSAGE, WEB_EVENT_MESSAGE
from ..sources import footers, lake, messages, snapshots, tables
from ..sources.monthly import MonthlyTable, months_later, months_of_quarters, quarter_start
from ..sources.state import StateTable, bucket_unit, year_unit, quarter_unit
from ..streaming import persist, realtime, sketched, windowed
from ..streaming.historical import HistoricalMetrics
from . import history, staging

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# Global indicators and rankings


@query
def global_kpis(spark, folder):
    return kpis.global_kpis(tables.sales(spark, folder, "id_pedido", "valor_total_compra"), exact=True)


def _agrees(sketch, ids):
    """Whether a streamed or batch sketch is near the exact count, and equals the sketch of the same ids in one pass."""
    exact, once = ids.agg(F.count_distinct("id")).scalar(), ids.agg(F.approx_count_distinct("id")).scalar()
    return exact, kpis.within_error(sketch, exact) & (sketch == once)


def _checked_kpis(sketched, spark, folder):
    """Indicators with the exact number of orders, and whether the sketch agrees with it."""
    sketch, revenue_sum = F.col("pedidos_totais_global"), F.col("receita_total_global")
    exact, agrees = _agrees(sketch, tables.sales(spark, folder, "id_pedido").select(F.col("id_pedido").cast("string").alias("id")))
    return sketched.select(
        revenue_sum, exact.alias("pedidos_totais_global"), agrees.alias("dentro_do_erro"),
        (F.abs(F.col("ticket_medio_global") - F.try_divide(revenue_sum, sketch)) < 1e-9).alias("ticket_coerente"),
    )


def _checked_carts(sketched, sales):
    exact, agrees = _agrees(F.col("total"), sales.select(F.col("id_carrinho").alias("id")))
    return sketched.select(exact.alias("total"), agrees.alias("dentro_do_erro"))


@query
def global_kpis_approx(spark, folder):
    sales = tables.sales(spark, folder, "id_pedido", "valor_total_compra")
    sales = sales.withColumn("id_pedido", F.col("id_pedido").cast("string"))
    return _checked_kpis(kpis.global_kpis(sales), spark, folder)


@query
def revenue_by_category(spark, folder):
    sales = tables.sales(spark, folder, "id_produto", "valor_total_compra")
    by_category = kpis.category_revenue_from_catalog(sales, tables.catalog(spark, folder))
    return by_category.orderBy(F.desc("receita"), "categoria")


@query
def top5_items(spark, folder):
    sales = tables.sales(spark, folder, "id_produto")
    return kpis.top_items(kpis.item_counts_from_catalog(sales, tables.catalog(spark, folder)))


@query
def carts_created_total(spark, folder):
    return kpis.carts_created(tables.web_events(spark, folder))


@query
def carts_converted_total(spark, folder):
    return kpis.carts_converted(tables.purchases(spark, folder), exact=True)


@query
def carts_converted_approx(spark, folder):
    return _checked_carts(kpis.carts_converted(tables.purchases(spark, folder)), tables.purchases(spark, folder))


@query
def conversion_rate(spark, folder):
    return kpis.conversion_rates(
        kpis.carts_created(tables.web_events(spark, folder)),
        kpis.carts_converted(tables.purchases(spark, folder), exact=True),
    )


# Daily revenue


def _segments(spark, folder):
    return tables.customers(spark, folder, "id_usuario", "segmento_cliente")


def _daily(spark, folder, *more):
    sales = tables.sales(
        spark, folder, "id_transacao", "id_usuario", "valor_total_compra", "data_compra", *more
    )
    return sales, _segments(spark, folder)


@query
def daily_revenue(spark, folder):
    return revenue.daily_revenue(*_daily(spark, folder))


@query
def revenue_growth_lag(spark, folder):
    daily = revenue.daily_revenue(*_daily(spark, folder))
    return revenue.newest_first(revenue.growth_since_last_sale_day(daily))


@query
def revenue_growth_calendar(spark, folder):
    daily = revenue.daily_revenue(*_daily(spark, folder))
    return revenue.newest_first(revenue.growth_since_yesterday(daily))


@query
def daily_metrics_last_30_days(spark, folder):
    """The 30 days up to the newest sale; only the months that they touch are opened."""
    stored = staging.monthly_sales(spark, folder)
    newest = stored.newest(spark)
    # The days shown, and one more for the growth of the first, begin in the month before or the one before that.
    recent = stored.read(spark, since=months_later(newest, -2))
    last = F.to_date(stored.read(spark, since=newest).agg(F.max("data_compra")).scalar())
    recent = recent.filter(F.col("data_compra") >= F.date_sub(last, 31).cast("timestamp"))
    growth = revenue.growth_since_yesterday(revenue.daily_revenue(recent, _segments(spark, folder)))
    return revenue.newest_first(revenue.trailing_days(growth, 30, last))


@query
def daily_metrics_by_date(spark, folder):
    """Presentation order of the daily table: oldest day first."""
    return revenue.daily_revenue(*_daily(spark, folder)).orderBy("data", "segmento_cliente")


# Products per quarter


def _units(spark, folder, *more):
    return tables.sales(spark, folder, "id_produto", "quantidade_produto", "data_compra", *more)


@query
def units_by_quarter(spark, folder):
    return products.units_by_quarter(_units(spark, folder))


@query
def top10_by_quarter(spark, folder):
    return products.rank_in_quarter(products.units_by_quarter(_units(spark, folder)))


@query
def top10_last_4_quarters(spark, folder):
    """The four quarters before that of the newest month, which the folder names tell."""
    stored = staging.monthly_sales(spark, folder)
    end = quarter_start(stored.newest(spark))
    recent = stored.read(spark, since=months_later(end, -12), before=end)
    return products.newest_quarters_first(products.rank_in_quarter(products.units_by_quarter(recent)))


@query
def top10_named(spark, folder):
    ranked = products.rank_in_quarter(products.units_by_quarter(_units(spark, folder)))
    return products.newest_quarters_first(
        products.with_product_names(ranked, tables.catalog(spark, folder))
    )


@query
def available_quarters(spark, folder):
    """Served from the published ranking."""
    return products.available_quarters(staging.published_ranking(spark, folder))


@query
def available_years(spark, folder):
    """Served from the published ranking."""
    return products.available_years(staging.published_ranking(spark, folder))


@query
def top10_slice_latest(spark, folder):
    """The latest quarter of the published ranking, with the column names shown to readers."""
    named = products.quarter_slice(staging.published_ranking(spark, folder))
    return named.withColumnsRenamed({"nome_produto": "produto", "unidades_vendidas": "qtd_vendida"})


# Carts


@query
def abandoned_carts(spark, folder):
    created = carts.created_carts(tables.web_events(spark, folder))
    return carts.abandoned_carts(created, carts.finished_carts(tables.purchases(spark, folder)))


@query
def abandoned_cart_rate(spark, folder):
    return carts.abandonment_rate(tables.web_events(spark, folder), tables.purchases(spark, folder))


# Cleaning and parsing


def _as_text(df, *names):
    """Columns as files without types hold them."""
    return df.withColumns({name: F.col(name).cast("string") for name in names})


@query
def clean_transactions(spark, folder):
    sales = tables.sales(
        spark, folder, "id_transacao", "id_pedido", "id_usuario", "id_produto", "quantidade_produto",
        "valor_total_compra", "data_compra", "metodo_pagamento", "status_pedido", "id_carrinho",
    )
    return cleaning.clean_transactions(_as_text(sales, "valor_total_compra", "data_compra"))


@query
def clean_clients(spark, folder):
    return cleaning.clean_clients(_as_text(tables.customers(
        spark, folder, "id_usuario", "nome_usuario", "email_usuario", "data_cadastro",
        "segmento_cliente", "cidade", "estado", "pais",
    ), "data_cadastro"))


@query
def clean_products(spark, folder):
    return cleaning.clean_products(_as_text(tables.catalog(spark, folder), "preco_unitario", "estoque_disponivel"))


@query
def clean_web_events(spark, folder):
    return cleaning.clean_web_events(_as_text(tables.web_events(spark, folder), "timestamp_evento"))


@query
def parse_json_events(spark, folder):
    """Events written as JSON text and parsed back."""
    texts = tables.web_events(spark, folder).select(
        staging.as_json(WEB_EVENT_MESSAGE.fieldNames())
    )
    return cleaning.parse_messages(texts, WEB_EVENT_MESSAGE)


@query
def rejected_messages(spark, folder):
    """Bare event names among the messages are no JSON objects and end up as rejects."""
    events = tables.web_events(spark, folder)
    texts = events.select(
        F.when(F.col("tipo_evento") == CART_CREATED, F.col("tipo_evento"))
        .otherwise(F.to_json(F.struct(*WEB_EVENT_MESSAGE.fieldNames()))).alias("value")
    )
    return cleaning.rejected_messages(texts, WEB_EVENT_MESSAGE).groupBy("value").agg(
        F.count(F.lit(1)).alias("linhas")
    )


@query
def rejected_values(spark, folder):
    """Values the cleaning casts cannot read: here order priorities offered as prices."""
    catalog = tables.table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("preco_unitario"), F.lit(1).alias("estoque_disponivel")
    )
    return cleaning.rejected(catalog, "catalogo_produtos")


# Ingestion and audits


@query
def row_count_audit(spark, folder):
    """Counted from the footers."""
    names = ["customer", "part", "events", "lineitem"]
    return footers.row_counts(spark, {n: f"{folder}/{n}.parquet" for n in names})


@query
def id_bounds(spark, folder):
    """From the footers."""
    return footers.id_bounds(spark, f"{folder}/orders.parquet", "o_orderkey")


@query
def full_reload(spark, folder):
    """Bronze tables reloaded twice over; what is stored is the second load."""
    root = staging.new_folder(spark, "bronze")
    source = {"catalogo_produtos": clean_products(spark, folder)}
    lake.full_reload(source, root)
    lake.full_reload(source, root)
    return lake.current(spark, f"{root}/catalogo_produtos")


@query
def full_reload_audit(spark, folder):
    """All four bronze tables reloaded in cleaned form, and counted."""
    root = staging.new_folder(spark, "bronze")
    source = {
        "transacoes_vendas": clean_transactions(spark, folder),
        "eventos_web": clean_web_events(spark, folder),
        "dados_clientes": clean_clients(spark, folder),
        "catalogo_produtos": clean_products(spark, folder),
    }
    lake.full_reload(source, root)
    return lake.row_counts({name: lake.current(spark, f"{root}/{name}") for name in source})


@query
def incremental_load(spark, folder):
    """Older orders first, but every seventh of them late; then all orders; a rerun adds nothing."""
    path = staging.new_folder(spark, "bronze-orders")
    orders = tables.table(spark, folder, "orders")
    middle = orders.agg((F.max("o_orderkey") / 2).cast("long")).scalar()
    first = (F.col("o_orderkey") <= middle) & (F.col("o_orderkey") % 7 != 3)
    lake.ingest_increment(orders.filter(first), path, "o_orderkey")
    lake.ingest_increment(orders, path, "o_orderkey")
    lake.ingest_increment(orders, path, "o_orderkey")
    return lake.ingested(spark, path)


# Upserts. The first load is the first lines of all orders; what follows touches the same keys.

FIRST, LATER = "linha <= 3", "linha > 3"


def _state(spark, name, unit, insert_only=False):
    table = StateTable(staging.new_folder(spark, name), GOLD[name], unit, insert_only)
    table.bootstrap(spark)
    return table


@query
def upsert_replace(spark, folder):
    sales, customers = _daily(spark, folder, "linha")
    table = _state(spark, "receita_diaria", year_unit("data"))
    none = F.lit(None).cast("double").alias(revenue.GROWTH)
    first = revenue.daily_revenue(sales.filter(FIRST), customers).select("*", none)
    table.write(first, 0)
    complete = revenue.daily_revenue(sales, customers).select("*", none)
    keys = ["data", "segmento_cliente"]
    table.write(upsert.upsert_replace(table.read(spark, before=1), complete, keys), 1)
    return table.read(spark).drop(revenue.GROWTH)


@query
def upsert_add(spark, folder):
    sales = _units(spark, folder, "linha")
    table = _state(spark, "produtos_agregados_trimestral", F.col("ano"))
    keys, amounts = ["ano", "trimestre", "id_produto"], ["unidades_vendidas"]
    for batch, load in enumerate([FIRST, LATER, LATER]):
        # The last load is a replay of batch 1.
        batch = min(batch, 1)
        partial = products.units_by_quarter(sales.filter(load))
        table.write(upsert.upsert_add(table.read(spark, batch), partial, keys, amounts), batch)
    return table.read(spark)


@query
def upsert_insert_absent(spark, folder):
    table = _state(spark, "carrinhos_criados", bucket_unit("id_carrinho"), insert_only=True)
    loads = [tables.web_events(spark, folder).filter(F.col("tipo_evento") == CART_CREATED),
             tables.purchases(spark, folder)]
    for batch, load in enumerate(loads):
        fresh = upsert.absent_from(table.read(spark, batch), load.select("id_carrinho"), ["id_carrinho"])
        table.write(fresh, batch)
    return table.read(spark)


@query
def replace_quarter(spark, folder):
    """Rankings of the first lines are replaced as whole quarters: no product keeps an old rank."""
    sales, catalog = _units(spark, folder, "linha"), tables.catalog(spark, folder)
    table = _state(spark, "produtos_top10_trimestral", quarter_unit())

    def ranked(rows):
        return products.with_product_names(
            products.rank_in_quarter(products.units_by_quarter(rows)), catalog
        )

    table.write(ranked(sales.filter(FIRST)), 0)
    table.write(ranked(sales), 1)
    return table.read(spark)


@query
def replace_quarter_frames(spark, folder):
    """The same replacement as a plain DataFrame operator."""
    sales = _units(spark, folder, "linha")
    old = products.rank_in_quarter(products.units_by_quarter(sales.filter(FIRST)))
    new = products.rank_in_quarter(products.units_by_quarter(sales))
    return upsert.replace_group(old, new, ["ano", "trimestre"])


@query
def batch_touched_quarters(spark, folder):
    """The quarters that each of the loads touches."""
    sales = _units(spark, folder, "linha")
    loads = [products.touched_quarters(sales.filter(load)).withColumn("carga", F.lit(number)) for number, load in enumerate([FIRST, LATER])]
    return loads[0].unionByName(loads[1])


@query
def units_of_touched_quarters(spark, folder):
    """Units of the quarters in which urgent orders were placed in 2000; only their months are opened."""
    stored = staging.monthly_sales(spark, folder)
    batch = stored.read(spark, since=date(2000, 1, 1), before=date(2001, 1, 1)).filter("metodo_pagamento = '1-URGENT'")
    # Bounded by the calendar.
    touched = [(r.ano, r.trimestre) for r in products.touched_quarters(batch).collect()]
    return products.units_by_quarter(stored.read(spark, months=months_of_quarters(touched)))


@query
def previous_day_rows_for_batch(spark, folder):
    """Stored rows of the day before each (day, segment) that urgent orders touch."""
    sales, customers = _daily(spark, folder, "metodo_pagamento")
    batch = revenue.daily_revenue(sales.filter("metodo_pagamento = '1-URGENT'"), customers)
    return revenue.rows_of_previous_day(revenue.daily_revenue(sales, customers), batch)


@query
def batch_growth_against_history(spark, folder):
    """Totals of a batch (urgent orders) compared with the stored totals of the day before."""
    sales, customers = _daily(spark, folder, "metodo_pagamento")
    batch = revenue.daily_revenue(sales.filter("metodo_pagamento = '1-URGENT'"), customers)
    return revenue.join_yesterday(batch, revenue.daily_revenue(sales, customers))


# Snapshots


def _store(spark):
    return snapshots.SnapshotStore(staging.new_folder(spark, "snapshots"))


def _read_back(spark, store, key, schema):
    return store.rows(spark, KEYS[key], schema).drop("pagina", "posicao")


@query
def publish_snapshot(spark, folder):
    """The growth table published as JSON pages and parsed back."""
    store = _store(spark)
    growth = revenue_growth_calendar(spark, folder).drop("receita_dia_anterior")
    store.publish(growth, KEYS["daily_revenue"])
    return _read_back(spark, store, "daily_revenue", GOLD["receita_diaria"])


@query
def realtime_kpis_from_snapshot(spark, folder):
    """Indicators read from a published object; absent values are 0."""
    store = _store(spark)
    store.publish(global_kpis(spark, folder), KEYS["global_kpis"], "object")
    return kpis.kpis_or_zero(_read_back(spark, store, "global_kpis", _KPI_ROW))


@query
def conversion_rate_from_snapshot(spark, folder):
    store = _store(spark)
    store.publish(carts_created_total(spark, folder), KEYS["carts_created"], "object")
    store.publish(carts_converted_total(spark, folder), KEYS["carts_converted"], "object")
    return kpis.conversion_rates(
        _read_back(spark, store, "carts_created", "total long"),
        _read_back(spark, store, "carts_converted", "total long"),
    )


@query
def snapshot_retention(spark, folder):
    """Of daily sale snapshots, those of the last 48 hours before the newest event."""
    events = tables.purchases(spark, folder)
    daily = periods.sales_per_period(events, "day").withColumn(
        "publicado_em", F.col("periodo").cast("timestamp")
    )
    newest = events.agg(F.max("data_compra")).scalar()
    return snapshots.within_retention(daily, 48, newest).select("periodo", "vendas_totais")


@query
def history_recompute(spark, folder):
    """The batch pipeline end to end; all three metrics that it published, parsed back."""
    root, store = staging.new_folder(spark, "gold"), _store(spark)
    events, purchases = tables.web_events(spark, folder), tables.purchases(spark, folder)
    sales = tables.sales(
        spark, folder, "id_transacao", "id_usuario", "id_produto", "quantidade_produto",
        "valor_total_compra", "data_compra",
    )
    history.recompute(sales, _segments(spark, folder), events, root, store, finished=purchases)
    metrics = {
        "crescimento_receita": _read_back(spark, store, "batch_growth", _GROWTH_ROW),
        "produtos_mais_vendidos": _read_back(spark, store, "batch_top_products", _RANK_ROW),
        "taxa_abandono": store.value(spark, KEYS["batch_abandonment"], "double").withColumnRenamed("valor", "taxa_abandono"),
    }
    named = [frame.withColumn("metrica", F.lit(name)) for name, frame in metrics.items()]
    return named[0].unionByName(named[1], True).unionByName(named[2], True)


@query
def history_recompute_month(spark, folder):
    """Daily totals of the first lines, of which every month is computed again by itself from all lines."""
    stored, customers = staging.monthly_sales(spark, folder), _segments(spark, folder)
    totals = MonthlyTable(staging.new_folder(spark, "totals"), "data")
    totals.write(revenue.daily_revenue(stored.read(spark).filter(FIRST), customers))
    months = stored.months(spark)
    for part in (months[::2], months[1::2]):
        history.recompute_months(stored, customers, totals, part)
    return revenue.growth_since_yesterday(spark.read.parquet(totals.path).drop("mes"))


# Periods and averages


@query
def sales_per_period(spark, folder):
    sales = tables.sales(spark, folder, "valor_total_compra", "data_compra")
    return periods.sales_per_period(sales, "month")


@query
def orders_per_period(spark, folder):
    return periods.orders_per_period(tables.sales(spark, folder, "id_pedido", "data_compra"), "week")


@query
def avg_ticket_per_period(spark, folder):
    sales = tables.sales(spark, folder, "id_pedido", "valor_total_compra", "data_compra")
    return periods.ticket_per_period(sales, "quarter")


@query
def avg_ticket_variation(spark, folder):
    sales = tables.sales(spark, folder, "id_pedido", "valor_total_compra", "data_compra")
    return periods.ticket_variation(periods.ticket_per_period(sales, "month"))


@query
def revenue_per_user(spark, folder):
    return periods.revenue_per_user(tables.sales(spark, folder, "id_usuario", "valor_total_compra"))


@query
def revenue_per_user_by_segment(spark, folder):
    sales = tables.sales(spark, folder, "id_usuario", "valor_total_compra")
    return periods.revenue_per_user_by_segment(sales, _segments(spark, folder))


@query
def orders_per_customer(spark, folder):
    sales = tables.sales(spark, folder, "id_usuario", "id_pedido")
    return periods.orders_per_customer(sales, _segments(spark, folder))


def _sketched_columns(spark, folder):
    return tables.sales(spark, folder, "id_pedido", "id_carrinho", "valor_total_compra", "data_compra")


@query
def sketched_periods(spark, folder):
    """Orders and carts of every period and of all time, from one stored sketch a day."""
    path = staging.new_folder(spark, "sketches")
    sketches.daily_sketches(_sketched_columns(spark, folder)).write.parquet(path)
    return sketches.all_periods(spark.read.parquet(path))


# Streams, run to the end of their input

ALL = {"availableNow": True}

_KPI_ROW = "receita_total_global double, pedidos_totais_global long, ticket_medio_global double"
_GROWTH_ROW = ("data date, segmento_cliente string, receita_total_diaria double, numero_de_pedidos long, "
               "receita_dia_anterior double, `crescimento_receita_d-1` double")
_RANK_ROW = "ano int, trimestre int, rank int, id_produto long, unidades_vendidas long"


def _message_stream(spark, path):
    return messages.folder_stream(spark, path, staging.files_per_batch(spark, path))


def _realtime(spark, folder, metric, schema):
    stage = {"sales": staging.sales_messages, "events": staging.event_messages}
    source = _message_stream(spark, stage[realtime.METRICS[metric].topic](spark, folder))
    store, checkpoints = _store(spark), staging.new_folder(spark, "checkpoint")
    realtime.start_metric(metric, source, store, checkpoints, **ALL).awaitTermination()
    return _read_back(spark, store, metric, schema)


@query
def stream_global_kpis(spark, folder):
    """The streamed indicators, the sketch of orders held against the exact count."""
    return _checked_kpis(_realtime(spark, folder, "global_kpis", _KPI_ROW), spark, folder)


@query
def stream_category(spark, folder):
    return _realtime(spark, folder, "category_revenue", "categoria string, receita double")


@query
def stream_top5(spark, folder):
    return _realtime(spark, folder, "top_items", "item string, total_vendido long")


@query
def stream_carts_created(spark, folder):
    return _realtime(spark, folder, "carts_created", "total long")


@query
def stream_carts_converted(spark, folder):
    sales = tables.sales(spark, folder, "id_carrinho", strategy="merge")
    return _checked_carts(_realtime(spark, folder, "carts_converted", "total long"), sales)


def _sales_stream(spark, folder):
    return staging.follow(spark, staging.bronze_sales(spark, folder))


def _historical(spark, folder):
    metrics = HistoricalMetrics(
        staging.new_folder(spark, "gold"), _store(spark),
        _segments(spark, folder), tables.catalog(spark, folder),
    )
    return metrics, staging.new_folder(spark, "checkpoint")


@query
def stream_daily_revenue(spark, folder):
    metrics, checkpoints = _historical(spark, folder)
    metrics.start_daily_revenue(_sales_stream(spark, folder), checkpoints, **ALL).awaitTermination()
    return metrics.gold["receita_diaria"].read(spark)


@query
def stream_units(spark, folder):
    metrics, checkpoints = _historical(spark, folder)
    metrics.start_top_products(_sales_stream(spark, folder), checkpoints, **ALL).awaitTermination()
    return metrics.gold["produtos_agregados_trimestral"].read(spark)


@query
def stream_top10(spark, folder):
    """The published ranking after all micro-batches."""
    metrics, checkpoints = _historical(spark, folder)
    metrics.start_top_products(_sales_stream(spark, folder), checkpoints, **ALL).awaitTermination()
    return _read_back(spark, metrics.store, "top_products", GOLD["produtos_top10_trimestral"])


@query
def stream_abandonment(spark, folder):
    metrics, checkpoints = _historical(spark, folder)
    events = staging.follow(spark, staging.bronze_events(spark, folder))
    metrics.start_carts(
        tables.web_events(spark, folder, events), tables.purchases(spark, folder, events),
        checkpoints, **ALL,
    ).awaitTermination()
    return _read_back(spark, metrics.store, "abandonment", "value string")


@query
def stream_cart_ids(spark, folder):
    """The id tables that the stream keeps: each cart once for each mark it has."""
    metrics, checkpoints = _historical(spark, folder)
    events = staging.follow(spark, staging.bronze_events(spark, folder))
    metrics.start_carts(
        tables.web_events(spark, folder, events), tables.purchases(spark, folder, events),
        checkpoints, **ALL,
    ).awaitTermination()
    state = metrics.cart_state
    return state.ids(spark, "criado").withColumn("marca", F.lit("criado")).unionByName(
        state.ids(spark, "finalizado").withColumn("marca", F.lit("finalizado")))


def _persisted(spark, staged, table):
    path, checkpoints = staging.new_folder(spark, "persisted"), staging.new_folder(spark, "checkpoint")
    source = _message_stream(spark, staged)
    persist.start_persist(source, table, path, checkpoints, **ALL).awaitTermination()
    return persist.persisted(spark, path, table)


@query
def stream_persist(spark, folder):
    """Transaction messages persisted to bronze."""
    return _persisted(spark, staging.sales_messages(spark, folder), "transacoes_vendas")


@query
def stream_persist_events(spark, folder):
    """Web event messages persisted to bronze."""
    return _persisted(spark, staging.event_messages(spark, folder), "eventos_web")


@query
def stream_rejects(spark, folder):
    """Unreadable messages of a persisted topic: here cart creations that came as bare words."""
    path, checkpoints = staging.new_folder(spark, "persisted"), staging.new_folder(spark, "checkpoint")
    source = _message_stream(spark, staging.event_messages(spark, folder, CART_CREATED))
    persist.start_persist(source, "eventos_web", path, checkpoints, **ALL).awaitTermination()
    return persist.rejected(spark, persist.rejects_path(path)).groupBy("value").agg(F.count(F.lit(1)).alias("linhas"))


def _windows(spark, folder):
    """Purchases streamed by time, every fiftieth of the first third of the time in the last load."""
    sales = tables.purchases(spark, folder, staging.follow(spark, staging.events_by_time(spark, folder)))
    metric = windowed.WindowedSales(staging.new_folder(spark, "windows"), sales.schema)
    metric.start(sales, staging.new_folder(spark, "checkpoint"), **ALL).awaitTermination()
    return metric


@query
def stream_windowed_sales(spark, folder):
    """Daily windows that are final two days behind the newest purchase; later sales of a final day are left out."""
    return _windows(spark, folder).final(spark).select(F.to_date("inicio").alias("dia"), "vendas_totais", "linhas")


@query
def stream_late_rows(spark, folder):
    """The sales that came when their day was final, as they came."""
    return _windows(spark, folder).late_rows(spark)


@query
def stream_sketched_periods(spark, folder):
    """The same from the day sketches that a stream of messages keeps."""
    days = sketched.SketchedDays(staging.new_folder(spark, "sketches"))
    columns = ("id_pedido", "id_carrinho", "valor_total_compra", "data_compra")
    sales = cleaning.parse_messages(_message_stream(spark, staging.sales_messages(spark, folder)), TRANSACTION_MESSAGE, columns)
    days.start(sales, staging.new_folder(spark, "checkpoint"), **ALL).awaitTermination()
    return sketches.all_periods(days.read(spark))
