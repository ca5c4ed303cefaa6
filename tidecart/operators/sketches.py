"""Distinct orders and carts as sketches that can be put together: one for each day, united to any longer period.

A sketch of a day is stored once; weeks, months, quarters and the whole are unions of days, without the sales. The union
of the days' sketches holds what one sketch over all their sales would, whatever days and batches they came in.
"""

from pyspark.sql import functions as F

from ..functions.expressions import amount, period_start, units, wide_sum

#: Registers are 2 to the power of this; 12 gives a standard error of some 1.6 %.
PRECISION = 12
DAILY = "dia date, pedidos binary, carrinhos binary, unidades long, linhas long"
PERIODS = ("day", "week", "month", "quarter", "year")


def daily_sketches(sales, precision=PRECISION):
    """Sketches of order and cart ids, revenue (in millionths) and lines of each day."""
    sketch = lambda column: F.hll_sketch_agg(F.col(column).cast("string"), F.lit(precision)).alias
    return sales.groupBy(F.to_date("data_compra").alias("dia")).agg(
        sketch("id_pedido")("pedidos"), sketch("id_carrinho")("carrinhos"),
        F.sum(units("valor_total_compra")).alias("unidades"), F.count(F.lit(1)).alias("linhas"))


def united(daily, *by):
    """Sketches of the same group put together."""
    return daily.groupBy(*by).agg(
        F.hll_union_agg("pedidos").alias("pedidos"), F.hll_union_agg("carrinhos").alias("carrinhos"),
        wide_sum(F.col("unidades")).alias("unidades"), F.sum("linhas").alias("linhas"))


def folded(daily):
    """One row a day from the rows of several batches."""
    return united(daily, "dia").select("dia", "pedidos", "carrinhos", F.col("unidades").cast("long"), "linhas")


def estimate(column):
    """The count of a sketch. A sketch that was never united counts by the order of its rows; united with itself it counts by
    what it holds, as all united ones do."""
    return F.hll_sketch_estimate(F.hll_union(column, column))


def _shown(sketches, period, start):
    orders, revenue = estimate("pedidos"), amount(F.col("unidades"))
    return sketches.select(
        F.lit(period).alias("periodo"), start.cast("date").alias("inicio"), orders.alias("numero_pedidos"),
        estimate("carrinhos").alias("carrinhos"), revenue.alias("vendas_totais"), "linhas",
        F.try_divide(revenue, orders).alias("ticket_medio"))


def per_period(daily, period="month"):
    """Orders, carts, revenue and average ticket of each period, from the days' sketches."""
    return _shown(united(daily, period_start("dia", period).alias("inicio")), period, F.col("inicio"))


def overall(daily):
    """The same over everything (one row)."""
    return _shown(united(daily), "all", F.lit(None))


def all_periods(daily):
    """Every period of every length, and the whole."""
    frame = overall(daily)
    for period in PERIODS:
        frame = frame.unionByName(per_period(daily, period))
    return frame
