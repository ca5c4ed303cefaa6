"""Schemas, event names and snapshot keys shared by batch and streaming code.

Fixed values: the column names, event names and snapshot keys below are part of the
data contract, so results can be compared by name.
"""

from pyspark.sql import types as T


def _schema(**columns):
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# Stream messages. Ids are 64-bit: the key space outgrows 32 bits long before 100 TB.
TRANSACTION_MESSAGE = _schema(
    id_pedido=T.StringType(),
    id_usuario=T.LongType(),
    nome_usuario=T.StringType(),
    id_produto=T.LongType(),
    categoria=T.StringType(),
    item=T.StringType(),
    valor_total_compra=T.DoubleType(),
    quantidade_produto=T.IntegerType(),
    data_compra=T.TimestampType(),
    metodo_pagamento=T.StringType(),
    status_pedido=T.StringType(),
    id_carrinho=T.StringType(),
)

WEB_EVENT_MESSAGE = _schema(
    id_usuario=T.LongType(),
    id_sessao=T.StringType(),
    tipo_evento=T.StringType(),
    id_carrinho=T.StringType(),
    id_produto=T.LongType(),
    timestamp_evento=T.TimestampType(),
)

# Columns kept when messages are persisted; names and labels are looked up from the dimensions.
TRANSACTION_ROW = [
    "id_pedido", "id_usuario", "id_produto", "quantidade_produto", "valor_total_compra",
    "data_compra", "metodo_pagamento", "status_pedido", "id_carrinho",
]
WEB_EVENT_ROW = [
    "id_usuario", "id_sessao", "id_carrinho", "tipo_evento", "id_produto", "timestamp_evento",
]

# Gold tables.
GOLD = {
    "receita_diaria": T.StructType([
        T.StructField("data", T.DateType(), True),
        T.StructField("segmento_cliente", T.StringType(), True),
        T.StructField("receita_total_diaria", T.DoubleType(), True),
        T.StructField("numero_de_pedidos", T.LongType(), True),
        T.StructField("crescimento_receita_d-1", T.DoubleType(), True),
    ]),
    "produtos_agregados_trimestral": _schema(
        ano=T.IntegerType(),
        trimestre=T.IntegerType(),
        id_produto=T.LongType(),
        unidades_vendidas=T.LongType(),
    ),
    "produtos_top10_trimestral": _schema(
        ano=T.IntegerType(),
        trimestre=T.IntegerType(),
        rank=T.IntegerType(),
        id_produto=T.LongType(),
        nome_produto=T.StringType(),
        unidades_vendidas=T.LongType(),
    ),
    "carrinhos_criados": _schema(id_carrinho=T.StringType()),
    "carrinhos_finalizados": _schema(id_carrinho=T.StringType()),
}

# Web event vocabulary.
LOGIN = "login"
PRODUCT_VIEW = "visualizacao_produto"
CART_CREATED = "carrinho_criado"
CART_ADD = "produto_adicionado_carrinho"
CHECKOUT = "checkout_concluido"

# One registry of published snapshot keys, used by writers and readers alike.
KEYS = {
    "global_kpis": "realtime:metricas_globais",
    "category_revenue": "realtime:receita_por_categoria",
    "top_items": "realtime:top_5_produtos",
    "carts_created": "realtime:total_carrinhos_criados",
    "carts_converted": "realtime:total_carrinhos_convertidos",
    "daily_revenue": "historical:daily_revenue_metrics",
    "top_products": "historical:top10_products_quarterly",
    "abandonment": "historical:abandoned_cart_rate",
    "batch_growth": "historical:crescimento_receita",
    "batch_top_products": "historical:produtos_mais_vendidos",
    "batch_abandonment": "historical:taxa_abandono",
}
