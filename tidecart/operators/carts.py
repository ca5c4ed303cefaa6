"""Cart id sets, abandoned carts and the abandonment rate."""

from pyspark.sql import functions as F

from ..functions.expressions import percentage
from ..schemas import CART_CREATED


def created_carts(events):
    return events.filter(F.col("tipo_evento") == CART_CREATED).select("id_carrinho").distinct()


def finished_carts(sales):
    return sales.select("id_carrinho").distinct()


def abandoned_carts(created, finished):
    """Carts created and never finished."""
    return created.join(finished, "id_carrinho", "left_anti")


def mark(ids, created):
    """Cart ids marked as created or as finished; repeated ids are fine."""
    return ids.select(
        "id_carrinho", F.lit(created).alias("criado"), F.lit(not created).alias("finalizado")
    )


def merge_marks(marks):
    """One row per cart id with what is known about it.

    Both kinds of ids meet in one shuffle with map-side combine. A null id counts as one cart
    that can never be matched to a sale.
    """
    return marks.groupBy("id_carrinho").agg(
        F.bool_or("criado").alias("criado"),
        (F.bool_or("finalizado") & F.col("id_carrinho").isNotNull()).alias("finalizado"),
    )


def abandonment_rate(events, sales):
    """Created carts, abandoned carts and their percentage (one row, one job)."""
    created = events.filter(F.col("tipo_evento") == CART_CREATED)
    marks = mark(created, created=True).unionByName(mark(sales, created=False))
    counts = merge_marks(marks).agg(
        F.count_if("criado").alias("carrinhos_criados"),
        F.count_if(F.col("criado") & ~F.col("finalizado")).alias("carrinhos_abandonados"),
    )
    return counts.withColumn("taxa_abandono", rate(F.col("carrinhos_abandonados"), F.col("carrinhos_criados")))


def rate(abandoned, created):
    return percentage(abandoned, created)


def two_decimals(column):
    """The rate as published: text with two decimals."""
    return F.format_string("%.2f", column)
