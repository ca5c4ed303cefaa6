"""Standard SQL giving the same rows as the registered queries."""

# Sales facts and their columns. Each line item is a sale.
_SALES = "lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"
_VALUE = "cast(l_extendedprice AS decimal(18,2))"
_UNITS = "cast(sum(cast(l_quantity AS integer)) AS bigint)"
_DAY = "cast(o_orderdate AS date)"
_CART = "concat(user_id, '-', cast(ts AS date))"
_YEAR, _QUARTER = "cast(year(o_orderdate) AS integer)", "cast(quarter(o_orderdate) AS integer)"


def _sum(value):
    return f"cast(sum({value}) AS double)"


def _daily(where="true"):
    return f"""
        SELECT {_DAY} AS data, c_mktsegment AS segmento_cliente,
               {_sum(_VALUE)} AS receita_total_diaria, count(l_orderkey) AS numero_de_pedidos
        FROM {_SALES} LEFT JOIN customer ON o_custkey = c_custkey
        WHERE {where} GROUP BY 1, 2"""


def _growth(current, previous):
    return f"CASE WHEN {previous} > 0 THEN ({current} - {previous}) / {previous} END"


def _calendar_growth(daily):
    return f"""
        WITH d AS ({daily})
        SELECT d.*, y.receita_total_diaria AS receita_dia_anterior,
               {_growth('d.receita_total_diaria', 'y.receita_total_diaria')} AS "crescimento_receita_d-1"
        FROM d LEFT JOIN d y ON y.data = d.data - 1
            AND y.segmento_cliente IS NOT DISTINCT FROM d.segmento_cliente"""


def _by_quarter(where="true"):
    return f"""
        SELECT {_YEAR} AS ano, {_QUARTER} AS trimestre, l_partkey AS id_produto,
               {_UNITS} AS unidades_vendidas
        FROM {_SALES} WHERE {where} GROUP BY 1, 2, 3"""


def _top10(units):
    return f"""
        SELECT ano, trimestre, rank, id_produto, unidades_vendidas FROM (
            SELECT *, cast(row_number() OVER (PARTITION BY ano, trimestre
                ORDER BY unidades_vendidas DESC, id_produto) AS integer) AS rank
            FROM ({units}) u) r
        WHERE rank <= 10"""


def _named(top):
    return f"""
        SELECT ano, trimestre, rank, id_produto, p_name AS nome_produto, unidades_vendidas
        FROM ({top}) t LEFT JOIN part ON id_produto = p_partkey"""


_NEWEST = f"(SELECT max(o_orderdate) FROM {_SALES})"
_LAST_4 = _top10(_by_quarter(f"""
    o_orderdate >= date_trunc('quarter', {_NEWEST}) - INTERVAL 12 MONTH
    AND o_orderdate < date_trunc('quarter', {_NEWEST})"""))

_KPIS = f"""
    SELECT receita_total_global, pedidos_totais_global,
           receita_total_global / pedidos_totais_global AS ticket_medio_global
    FROM (SELECT {_sum(_VALUE)} AS receita_total_global,
                 count(DISTINCT l_orderkey) AS pedidos_totais_global FROM lineitem) k"""
_CATEGORY = f"""
    SELECT p_type AS categoria, {_sum(_VALUE)} AS receita
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1"""
_TOP5 = """
    SELECT p_name AS item, count(*) AS total_vendido
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    GROUP BY 1 ORDER BY total_vendido DESC, item LIMIT 5"""

_CREATED = "SELECT count(*) AS total FROM events WHERE event_type = 'click'"
_CONVERTED = f"SELECT count(DISTINCT {_CART}) AS total FROM events WHERE event_type = 'purchase'"
# Sketches are shown as the exact count and whether the sketch is within its error.
_CHECKED_KPIS = f"""
    SELECT receita_total_global, pedidos_totais_global, true AS dentro_do_erro, true AS ticket_coerente
    FROM ({_KPIS}) k"""
_CHECKED_CARTS = f"SELECT total, true AS dentro_do_erro FROM ({_CONVERTED}) c"
_CONVERSION = f"""
    SELECT criados AS carrinhos_criados, convertidos AS carrinhos_convertidos,
           CASE WHEN criados > 0 THEN convertidos / criados * 100 ELSE 0 END AS taxa_conversao,
           CASE WHEN criados > 0 THEN 100 - convertidos / criados * 100 ELSE 0 END AS taxa_abandono
    FROM (SELECT ({_CREATED}) AS criados, ({_CONVERTED}) AS convertidos) c"""

_ABANDONED = f"""
    SELECT DISTINCT {_CART} AS id_carrinho FROM events WHERE event_type = 'click'
    EXCEPT SELECT {_CART} FROM events WHERE event_type = 'purchase'"""
_ABANDONMENT = f"""
    SELECT carrinhos_criados, carrinhos_abandonados,
           CASE WHEN carrinhos_criados > 0
                THEN carrinhos_abandonados / carrinhos_criados * 100 ELSE 0 END AS taxa_abandono
    FROM (SELECT (SELECT count(DISTINCT {_CART}) FROM events WHERE event_type = 'click')
                     AS carrinhos_criados,
                 (SELECT count(*) FROM ({_ABANDONED}) a) AS carrinhos_abandonados) c"""

_EVENT_TYPE = """CASE event_type WHEN 'click' THEN 'carrinho_criado' WHEN 'purchase' THEN 'checkout_concluido'
    WHEN 'view' THEN 'visualizacao_produto' WHEN 'signup' THEN 'login' ELSE event_type END"""
_EVENT_FIELDS = f"""
    user_id AS id_usuario, concat(user_id, '-', hour(ts)) AS id_sessao, {_EVENT_TYPE} AS tipo_evento,
    {_CART} AS id_carrinho, cast(json_extract_string(props, '$.k') AS bigint) AS id_produto"""


def _period(unit):
    return f"cast(date_trunc('{unit}', o_orderdate) AS date) AS periodo"


_TICKETS = """
    SELECT *, vendas_totais / numero_pedidos AS ticket_medio FROM (
        SELECT {period}, {value} AS vendas_totais, count(DISTINCT l_orderkey) AS numero_pedidos
        FROM {sales} GROUP BY 1) p"""


def _tickets(unit):
    return _TICKETS.format(period=_period(unit), value=_sum(_VALUE), sales=_SALES)


_PER_USER = f"SELECT o_custkey, sum({_VALUE}) AS receita FROM {_SALES} GROUP BY 1"
_AVERAGE = "count(*) AS usuarios, cast(sum(receita) AS double) / count(*) AS receita_media"
_PURCHASES_PER_DAY = f"""
    SELECT cast(ts AS date) AS dia, {_sum('cast(value AS decimal(18,2))')} AS vendas_totais,
           count(*) AS linhas
    FROM events WHERE event_type = 'purchase' GROUP BY 1"""
# Every fiftieth event of the first third of the time comes last, when its day is final.
_LATE = """(event_id % 50 = 0 AND (epoch_us(ts) - (SELECT epoch_us(min(ts)) FROM events)) * 3
        < (SELECT epoch_us(max(ts)) - epoch_us(min(ts)) + 1 FROM events))"""
_ON_TIME = _PURCHASES_PER_DAY.replace("WHERE", f"WHERE NOT {_LATE} AND")
_NEWEST_PURCHASE = "(SELECT max(ts) FROM events WHERE event_type = 'purchase')"

_URGENT = "o_orderpriority = '1-URGENT'"

_LAG_GROWTH = f"""
    SELECT *, {_growth('receita_total_diaria', 'receita_dia_anterior')} AS "crescimento_receita_d-1"
    FROM (SELECT *, lag(receita_total_diaria) OVER (PARTITION BY segmento_cliente ORDER BY data)
          AS receita_dia_anterior FROM ({_daily()}) d) g"""

ORACLE = {
    "global_kpis": _KPIS,
    "global_kpis_approx": _CHECKED_KPIS,
    "carts_converted_approx": _CHECKED_CARTS,
    "revenue_by_category": _CATEGORY,
    "top5_items": _TOP5,
    "carts_created_total": _CREATED,
    "carts_converted_total": _CONVERTED,
    "conversion_rate": _CONVERSION,
    "daily_revenue": _daily(),
    "revenue_growth_lag": _LAG_GROWTH,
    "revenue_growth_calendar": _calendar_growth(_daily()),
    "daily_metrics_last_30_days": f"""
        SELECT * FROM ({_calendar_growth(_daily())}) g WHERE data >= cast({_NEWEST} AS date) - 30""",
    "daily_metrics_by_date": _daily(),
    "units_by_quarter": _by_quarter(),
    "top10_by_quarter": _top10(_by_quarter()),
    "top10_last_4_quarters": _LAST_4,
    "top10_named": _named(_top10(_by_quarter())),
    "available_quarters": f"SELECT DISTINCT {_YEAR} AS ano, {_QUARTER} AS trimestre FROM {_SALES}",
    "available_years": f"SELECT DISTINCT {_YEAR} AS ano FROM {_SALES}",
    "top10_slice_latest": f"""
        SELECT ano, trimestre, rank, id_produto, nome_produto AS produto, unidades_vendidas AS qtd_vendida
        FROM ({_named(_top10(_by_quarter()))}) t
        WHERE ano = year({_NEWEST}) AND trimestre = quarter({_NEWEST})""",
    "abandoned_carts": _ABANDONED,
    "abandoned_cart_rate": _ABANDONMENT,
    "clean_transactions": f"""
        SELECT l_orderkey AS id_transacao, l_orderkey AS id_pedido, o_custkey AS id_usuario,
               l_partkey AS id_produto, cast(l_quantity AS integer) AS quantidade_produto,
               cast({_VALUE} AS double) AS valor_total_compra, o_orderdate AS data_compra,
               o_orderpriority AS metodo_pagamento, o_orderstatus AS status_pedido,
               concat(o_custkey, '-', cast(o_orderdate AS date)) AS id_carrinho
        FROM {_SALES}""",
    "clean_clients": """
        SELECT c_custkey AS id_usuario, c_name AS nome_usuario, c_name || '@example.com' AS email_usuario,
               TIMESTAMP '2020-01-01 00:00:00' AS data_cadastro, c_mktsegment AS segmento_cliente,
               cast(NULL AS varchar) AS cidade, n_name AS estado, 'Brasil' AS pais
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "clean_products": """
        SELECT p_partkey AS id_produto, p_name AS nome_produto,
               concat(p_brand, ' ', p_name) AS descricao_produto, p_type AS categoria,
               cast(cast(p_retailprice AS decimal(18,2)) AS double) AS preco_unitario,
               p_size AS estoque_disponivel
        FROM part""",
    "clean_web_events": f"SELECT event_id AS id_evento, {_EVENT_FIELDS}, ts AS timestamp_evento FROM events",
    "parse_json_events": f"SELECT {_EVENT_FIELDS}, ts AS timestamp_evento FROM events",
    "rejected_messages": """
        SELECT 'carrinho_criado' AS value, count(*) AS linhas
        FROM events WHERE event_type = 'click' HAVING count(*) > 0""",
    "rejected_values": """
        SELECT count(o_orderpriority) AS preco_unitario, cast(0 AS bigint) AS estoque_disponivel FROM orders""",
    "row_count_audit": " UNION ALL ".join(
        f"SELECT '{t}' AS tabela, count(*) AS linhas FROM {t}"
        for t in ["customer", "part", "events", "lineitem"]
    ),
    "id_bounds": "SELECT min(o_orderkey) AS min_id, max(o_orderkey) AS max_id FROM orders",
    "full_reload": """
        SELECT p_partkey AS id_produto, p_name AS nome_produto,
               concat(p_brand, ' ', p_name) AS descricao_produto, p_type AS categoria,
               cast(cast(p_retailprice AS decimal(18,2)) AS double) AS preco_unitario,
               p_size AS estoque_disponivel
        FROM part""",
    "full_reload_audit": " UNION ALL ".join(
        f"SELECT '{name}' AS tabela, count(*) AS linhas FROM {t}"
        for name, t in [("transacoes_vendas", "lineitem"), ("eventos_web", "events"),
                        ("dados_clientes", "customer"), ("catalogo_produtos", "part")]
    ),
    "incremental_load": "SELECT * FROM orders",
    "upsert_replace": _daily(),
    "upsert_add": _by_quarter(),
    "upsert_insert_absent": f"""
        SELECT DISTINCT {_CART} AS id_carrinho FROM events WHERE event_type IN ('click', 'purchase')""",
    "replace_quarter": _named(_top10(_by_quarter())),
    "replace_quarter_frames": _top10(_by_quarter()),
    "batch_touched_quarters": f"""
        SELECT DISTINCT {_YEAR} AS ano, {_QUARTER} AS trimestre,
               cast(CASE WHEN l_linenumber > 3 THEN 1 ELSE 0 END AS integer) AS carga FROM {_SALES}""",
    "units_of_touched_quarters": f"""
        SELECT * FROM ({_by_quarter()}) u WHERE (ano, trimestre) IN (
            SELECT ({_YEAR}, {_QUARTER}) FROM {_SALES} WHERE {_URGENT} AND year(o_orderdate) = 2000)""",
    "previous_day_rows_for_batch": f"""
        SELECT d.* FROM ({_daily()}) d WHERE EXISTS (
            SELECT 1 FROM ({_daily(_URGENT)}) b WHERE b.data - 1 = d.data
                AND b.segmento_cliente IS NOT DISTINCT FROM d.segmento_cliente)""",
    "batch_growth_against_history": f"""
        WITH d AS ({_daily()}), b AS ({_daily(_URGENT)})
        SELECT b.*, d.receita_total_diaria AS receita_dia_anterior,
               {_growth('b.receita_total_diaria', 'd.receita_total_diaria')} AS "crescimento_receita_d-1"
        FROM b LEFT JOIN d ON d.data = b.data - 1
            AND d.segmento_cliente IS NOT DISTINCT FROM b.segmento_cliente""",
    "publish_snapshot": f"SELECT * EXCLUDE (receita_dia_anterior) FROM ({_calendar_growth(_daily())}) g",
    "realtime_kpis_from_snapshot": f"""
        SELECT receita_total_global AS receita, pedidos_totais_global AS pedidos,
               ticket_medio_global AS ticket_medio FROM ({_KPIS}) k""",
    "conversion_rate_from_snapshot": _CONVERSION,
    "snapshot_retention": f"""
        SELECT dia AS periodo, vendas_totais FROM ({_PURCHASES_PER_DAY}) p
        WHERE cast(dia AS timestamp) >= {_NEWEST_PURCHASE} - INTERVAL 48 HOUR""",
    "history_recompute": f"""
        SELECT *, 'crescimento_receita' AS metrica FROM ({_LAG_GROWTH}) g
        UNION ALL BY NAME SELECT *, 'produtos_mais_vendidos' AS metrica FROM ({_LAST_4}) r
        UNION ALL BY NAME SELECT taxa_abandono, 'taxa_abandono' AS metrica FROM ({_ABANDONMENT}) a""",
    "history_recompute_month": _calendar_growth(_daily()),
    "sales_per_period": f"SELECT {_period('month')}, {_sum(_VALUE)} AS vendas_totais FROM {_SALES} GROUP BY 1",
    "orders_per_period": f"""
        SELECT {_period('week')}, count(DISTINCT l_orderkey) AS numero_pedidos FROM {_SALES} GROUP BY 1""",
    "avg_ticket_per_period": _tickets("quarter"),
    "avg_ticket_variation": f"""
        SELECT *, {_growth('ticket_medio', 'ticket_anterior')} AS variacao_ticket
        FROM (SELECT *, lag(ticket_medio) OVER (ORDER BY periodo) AS ticket_anterior
              FROM ({_tickets('month')}) t) v""",
    "revenue_per_user": f"SELECT {_AVERAGE} FROM ({_PER_USER}) u",
    "revenue_per_user_by_segment": f"""
        SELECT c_mktsegment AS segmento_cliente, {_AVERAGE}
        FROM ({_PER_USER}) u LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
    "orders_per_customer": f"""
        SELECT clientes, pedidos, pedidos / clientes AS pedidos_por_cliente FROM (
            SELECT (SELECT count(*) FROM customer) AS clientes,
                   (SELECT count(DISTINCT o_orderkey) FROM {_SALES}
                    WHERE o_custkey IN (SELECT c_custkey FROM customer)) AS pedidos) n""",
    "stream_global_kpis": _CHECKED_KPIS,
    "stream_carts_converted": f"""
        SELECT count(DISTINCT concat(o_custkey, '-', cast(o_orderdate AS date))) AS total, true AS dentro_do_erro
        FROM {_SALES}""",
    "stream_category": _CATEGORY,
    "stream_top5": _TOP5,
    "stream_carts_created": _CREATED,
    "stream_daily_revenue": f"SELECT * EXCLUDE (receita_dia_anterior) FROM ({_calendar_growth(_daily())}) g",
    "stream_units": _by_quarter(),
    "stream_top10": _named(_top10(_by_quarter())),
    "stream_abandonment": f"SELECT printf('%.2f', taxa_abandono) AS value FROM ({_ABANDONMENT}) a",
    "stream_persist": f"""
        SELECT cast(l_orderkey AS varchar) AS id_pedido, o_custkey AS id_usuario, l_partkey AS id_produto,
               cast(l_quantity AS integer) AS quantidade_produto,
               cast({_VALUE} AS double) AS valor_total_compra, o_orderdate AS data_compra,
               o_orderpriority AS metodo_pagamento, o_orderstatus AS status_pedido,
               concat(o_custkey, '-', cast(o_orderdate AS date)) AS id_carrinho
        FROM {_SALES}""",
    "stream_persist_events": f"SELECT {_EVENT_FIELDS}, ts AS timestamp_evento FROM events",
    "stream_rejects": """
        SELECT 'carrinho_criado' AS value, count(*) AS linhas
        FROM events WHERE event_type = 'click' HAVING count(*) > 0""",
    "stream_windowed_sales": f"""
        SELECT * FROM ({_ON_TIME}) p
        WHERE cast(dia AS timestamp) + INTERVAL 1 DAY <= {_NEWEST_PURCHASE} - INTERVAL 2 DAY""",
    "stream_late_rows": f"""
        SELECT event_id AS id_pedido, user_id AS id_usuario, value AS valor_total_compra, {_CART} AS id_carrinho, ts AS data_compra
        FROM events WHERE event_type = 'purchase' AND {_LATE}""",
    "stream_cart_ids": f"""
        SELECT DISTINCT {_CART} AS id_carrinho, CASE event_type WHEN 'click' THEN 'criado' ELSE 'finalizado' END AS marca
        FROM events WHERE event_type IN ('click', 'purchase')""",
}
