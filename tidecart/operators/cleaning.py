"""Typed cleaning of the four bronze tables and of JSON messages."""

from pyspark.sql import functions as F
from pyspark.sql import types as T


def _typed(df, columns, **casts):
    """Project ``columns`` in order, replacing those named in ``casts`` by a tolerant cast.

    An unreadable value becomes null rather than failing the job; ``rejected`` counts them.
    """
    return df.select(*[
        F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c) for c in columns
    ])


#: The columns of the source tables in order, and the types of those that are cast.
_CLEANING = {
    "transacoes_vendas": (
        ["id_transacao", "id_pedido", "id_usuario", "id_produto", "quantidade_produto",
         "valor_total_compra", "data_compra", "metodo_pagamento", "status_pedido", "id_carrinho"],
        {"valor_total_compra": "double", "data_compra": "timestamp"},
    ),
    "dados_clientes": (
        ["id_usuario", "nome_usuario", "email_usuario", "data_cadastro",
         "segmento_cliente", "cidade", "estado", "pais"],
        {"data_cadastro": "timestamp"},
    ),
    "catalogo_produtos": (
        ["id_produto", "nome_produto", "descricao_produto", "categoria",
         "preco_unitario", "estoque_disponivel"],
        {"preco_unitario": "double", "estoque_disponivel": "int"},
    ),
    "eventos_web": (
        ["id_evento", "id_usuario", "id_sessao", "id_carrinho", "tipo_evento", "id_produto",
         "timestamp_evento"],
        {"timestamp_evento": "timestamp"},
    ),
}


def clean(df, table):
    """Bronze form of one of the four source tables."""
    columns, casts = _CLEANING[table]
    return _typed(df, columns, **casts)


def clean_transactions(df):
    return clean(df, "transacoes_vendas")


def clean_clients(df):
    return clean(df, "dados_clientes")


def clean_products(df):
    return clean(df, "catalogo_produtos")


def clean_web_events(df):
    return clean(df, "eventos_web")


def rejected(df, table):
    """One row: how many values of each cast column could not be read."""
    casts = _CLEANING[table][1]
    return df.agg(*[
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()).alias(c)
        for c, kind in casts.items()
    ])


def _decode(messages, schema, columns=None):
    """Each message next to its fields, of which only ``columns`` are decoded.

    A message is readable when it is a JSON object with at least one key, whatever columns are
    asked for; the keys are looked at only where no column has a value. The generator keeps the
    parser from running once per use of a field.
    """
    text = F.col("value").cast("string")
    wanted = T.StructType([f for f in schema if columns is None or f.name in columns])
    decoded = messages.select(text.alias("_text"), F.inline(F.array(F.from_json(text, wanted))))
    has_value = F.coalesce(*[F.col(f.name).cast("string") for f in wanted]).isNotNull()
    has_keys = F.coalesce(F.size(F.json_object_keys("_text")), F.lit(0)) > 0
    return decoded, has_value | has_keys


def parse_messages(messages, schema, columns=None):
    """Flatten JSON messages; a field of the wrong type is null, an unreadable message is left out."""
    decoded, readable = _decode(messages, schema, columns)
    return decoded.filter(readable).drop("_text")


def rejected_messages(messages, schema):
    """The raw text of unreadable messages."""
    decoded, readable = _decode(messages, schema)
    return decoded.filter(~readable).select(F.col("_text").alias("value"))
