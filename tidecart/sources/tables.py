"""The logical tables bound to the star-schema parquet files of a folder.

Each binding takes the columns that are wanted and joins only what they need: line items
are the sales facts, orders give date and customer, part and customer give labels. The joined
keys are primary keys, so leaving a left join out does not change the rows.
"""

from pyspark.sql import functions as F

from ..schemas import CART_CREATED, CHECKOUT, LOGIN, PRODUCT_VIEW

_FROM_LINE = {
    "id_transacao": "l_orderkey",
    "id_pedido": "l_orderkey",
    "id_produto": "l_partkey",
    "quantidade_produto": "cast(l_quantity AS int)",
    "valor_total_compra": "l_extendedprice",
    "linha": "l_linenumber",
}
_FROM_ORDER = {
    "id_usuario": "o_custkey",
    "data_compra": "cast(o_orderdate AS timestamp)",
    "metodo_pagamento": "o_orderpriority",
    "status_pedido": "o_orderstatus",
    "id_carrinho": "concat_ws('-', o_custkey, to_date(o_orderdate))",
}
_FROM_PART = {"categoria": "p_type", "item": "p_name"}
_FROM_CUSTOMER = {"nome_usuario": "c_name"}


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sales(spark, folder, *columns, strategy=None):
    """transacoes_vendas: one row per line item.

    Parts are joined while the lines are narrow, and customers to the orders, of which there are fewer than lines.
    ``strategy`` names a join strategy for all of them; without it the optimizer chooses by size.
    """
    wanted = set(columns)

    def other(name):
        return table(spark, folder, name).hint(strategy) if strategy else table(spark, folder, name)

    df = table(spark, folder, "lineitem")
    if wanted & set(_FROM_PART):
        part = other("part")
        df = df.join(part, df.l_partkey == part.p_partkey, "left")
    if wanted & (set(_FROM_ORDER) | set(_FROM_CUSTOMER)):
        orders = table(spark, folder, "orders")
        if wanted & set(_FROM_CUSTOMER):
            customer = other("customer")
            orders = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
        orders = orders.hint(strategy) if strategy else orders
        df = df.join(orders, df.l_orderkey == orders.o_orderkey, "left")
    every = {**_FROM_LINE, **_FROM_ORDER, **_FROM_PART, **_FROM_CUSTOMER}
    return df.selectExpr(*[f"{every[c]} AS {c}" for c in columns])


_CUSTOMER = {
    "id_usuario": "c_custkey",
    "nome_usuario": "c_name",
    "email_usuario": "concat(c_name, '@example.com')",
    "data_cadastro": "'2020-01-01'",
    "segmento_cliente": "c_mktsegment",
    "cidade": "cast(NULL AS string)",
    "estado": "n_name",
    "pais": "'Brasil'",
}


def customers(spark, folder, *columns):
    """dados_clientes."""
    df = table(spark, folder, "customer")
    if "estado" in columns:
        nation = table(spark, folder, "nation")
        df = df.join(nation, df.c_nationkey == nation.n_nationkey, "left")
    return df.selectExpr(*[f"{_CUSTOMER[c]} AS {c}" for c in columns])


def catalog(spark, folder):
    """catalogo_produtos."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id_produto"),
        F.col("p_name").alias("nome_produto"),
        F.concat_ws(" ", "p_brand", "p_name").alias("descricao_produto"),
        F.col("p_type").alias("categoria"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("preco_unitario"),
        F.col("p_size").alias("estoque_disponivel"),
    )


def web_events(spark, folder, events=None):
    """eventos_web: clicks create a user's cart of the day, purchases close it.

    ``events`` may be a stream of the table.
    """
    kind = F.col("event_type")
    events = table(spark, folder, "events") if events is None else events
    return events.select(
        F.col("event_id").alias("id_evento"),
        F.col("user_id").alias("id_usuario"),
        F.concat_ws("-", "user_id", F.hour("ts")).alias("id_sessao"),
        F.concat_ws("-", "user_id", F.to_date("ts")).alias("id_carrinho"),
        F.when(kind == "click", CART_CREATED).when(kind == "purchase", CHECKOUT)
        .when(kind == "view", PRODUCT_VIEW).when(kind == "signup", LOGIN)
        .otherwise(kind).alias("tipo_evento"),
        F.get_json_object("props", "$.k").cast("long").alias("id_produto"),
        F.col("ts").cast("timestamp").alias("timestamp_evento"),
    )


def purchases(spark, folder, events=None):
    """Sales as far as carts are concerned: the purchase events with their cart ids."""
    events = table(spark, folder, "events") if events is None else events
    return events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("id_pedido"),
        F.col("user_id").alias("id_usuario"),
        F.col("value").alias("valor_total_compra"),
        F.concat_ws("-", "user_id", F.to_date("ts")).alias("id_carrinho"),
        F.col("ts").cast("timestamp").alias("data_compra"),
    )
