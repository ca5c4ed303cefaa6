"""Sales, orders and tickets per calendar period, and averages per customer."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.expressions import amount, growth, period_start, total, units, wide_sum


def sales_per_period(sales, period="month"):
    return sales.groupBy(period_start("data_compra", period).alias("periodo")).agg(
        total("valor_total_compra").alias("vendas_totais")
    )


def orders_per_period(sales, period="month"):
    """Different orders per period (not sales lines)."""
    return sales.groupBy(period_start("data_compra", period).alias("periodo")).agg(
        F.count_distinct("id_pedido").alias("numero_pedidos")
    )


def ticket_per_period(sales, period="month"):
    """Revenue, orders and average ticket per period, in one pass."""
    return sales.groupBy(period_start("data_compra", period).alias("periodo")).agg(
        total("valor_total_compra").alias("vendas_totais"),
        F.count_distinct("id_pedido").alias("numero_pedidos"),
    ).withColumn("ticket_medio", F.try_divide("vendas_totais", "numero_pedidos"))


def ticket_variation(tickets):
    """Relative change of the average ticket against the previous period.

    The window runs over one row per calendar period, never over sales.
    """
    before = F.lag("ticket_medio").over(Window.orderBy("periodo"))
    return tickets.withColumn("ticket_anterior", before).withColumn(
        "variacao_ticket", growth(F.col("ticket_medio"), F.col("ticket_anterior"))
    )


def revenue_by_user(sales):
    return sales.groupBy("id_usuario").agg(F.sum(units("valor_total_compra")).alias("receita"))


def _mean(summed, count):
    return F.try_divide(amount(wide_sum(F.col(summed))), count)


def revenue_per_user(sales):
    """Average revenue over the users who bought anything (one row)."""
    return revenue_by_user(sales).agg(
        F.count(F.lit(1)).alias("usuarios"), _mean("receita", F.count(F.lit(1))).alias("receita_media")
    )


def revenue_per_user_by_segment(sales, customers):
    segments = customers.select("id_usuario", "segmento_cliente")
    return revenue_by_user(sales).join(segments, "id_usuario", "left").groupBy("segmento_cliente").agg(
        F.count(F.lit(1)).alias("usuarios"), _mean("receita", F.count(F.lit(1))).alias("receita_media")
    )


def orders_per_customer(sales, customers):
    """Average number of different orders over all customers, those without orders included."""
    orders = sales.groupBy("id_usuario").agg(F.count_distinct("id_pedido").alias("pedidos"))
    per_customer = customers.select("id_usuario").join(orders, "id_usuario", "left")
    return per_customer.agg(
        F.count(F.lit(1)).alias("clientes"),
        F.coalesce(F.sum("pedidos"), F.lit(0)).alias("pedidos"),
    ).withColumn("pedidos_por_cliente", F.try_divide("pedidos", "clientes"))
