"""Global indicators, category revenue and item ranking; the same frames serve batch and streams."""

from pyspark.sql import functions as F

from ..functions.expressions import amount, percentage, total, units
from ..schemas import CART_CREATED
from .lookup import sum_by_attribute


def global_kpis(sales, exact=False):
    """Revenue, orders and average ticket over everything seen so far (one row).

    Streams keep a distinct-count sketch; batch callers may ask for the exact count.
    """
    orders = F.count_distinct("id_pedido") if exact else F.approx_count_distinct("id_pedido")
    return sales.agg(
        total("valor_total_compra").alias("receita_total_global"),
        orders.alias("pedidos_totais_global"),
    ).withColumn(
        "ticket_medio_global", F.try_divide("receita_total_global", "pedidos_totais_global")
    )


def within_error(sketch, exact, error=0.15):
    """Whether a distinct-count sketch is within three of its standard errors (5 %) of the exact count."""
    return F.abs(sketch - exact) <= F.greatest(exact * error, F.lit(1))


def category_revenue(sales):
    """Revenue by category, for sales that already carry their category."""
    return sales.groupBy("categoria").agg(total("valor_total_compra").alias("receita"))


def category_revenue_from_catalog(sales, catalog):
    """Revenue by category when the category has to be looked up in the catalog."""
    by_category = sum_by_attribute(
        sales, catalog, "id_produto", ["categoria"],
        {"receita": F.sum(units("valor_total_compra"))},
    )
    return by_category.withColumn("receita", amount(F.col("receita")))


def item_counts(sales):
    """Line items sold by item name (rows, not quantities)."""
    return sales.groupBy("item").agg(F.count(F.lit(1)).alias("total_vendido"))


def item_counts_from_catalog(sales, catalog):
    return sum_by_attribute(
        sales, catalog.withColumnRenamed("nome_produto", "item"), "id_produto", ["item"],
        {"total_vendido": F.count(F.lit(1))},
    )


def top_items(counts, n=5):
    """The ``n`` best-selling items; equal counts are ordered by name."""
    return counts.orderBy(F.desc("total_vendido"), "item").limit(n)


def carts_created(events):
    """Number of cart creation events."""
    created = events.filter(F.col("tipo_evento") == CART_CREATED)
    return created.agg(F.count(F.lit(1)).alias("total"))


def carts_converted(sales, exact=False):
    """Number of different carts that reached a sale."""
    carts = F.count_distinct("id_carrinho") if exact else F.approx_count_distinct("id_carrinho")
    return sales.agg(carts.alias("total"))


def conversion_rates(created, converted):
    """Conversion and abandonment percentages from the two one-row counters."""
    counters = created.select(F.col("total").alias("criados"), F.lit(0).cast("long").alias("convertidos"))
    counters = counters.unionByName(
        converted.select(F.lit(0).cast("long").alias("criados"), F.col("total").alias("convertidos"))
    ).agg(
        F.coalesce(F.sum("criados"), F.lit(0)).alias("carrinhos_criados"),
        F.coalesce(F.sum("convertidos"), F.lit(0)).alias("carrinhos_convertidos"),
    )
    made, sold = F.col("carrinhos_criados"), F.col("carrinhos_convertidos")
    return counters.select(
        made, sold,
        percentage(sold, made).alias("taxa_conversao"),
        F.when(made > 0, 100 - sold / made * 100).otherwise(F.lit(0.0)).alias("taxa_abandono"),
    )


def kpis_or_zero(snapshot):
    """The global indicators of a snapshot, 0 for whatever is missing; always one row."""
    return snapshot.agg(
        F.coalesce(F.max("receita_total_global"), F.lit(0.0)).alias("receita"),
        F.coalesce(F.max("pedidos_totais_global"), F.lit(0)).cast("long").alias("pedidos"),
        F.coalesce(F.max("ticket_medio_global"), F.lit(0.0)).alias("ticket_medio"),
    )
