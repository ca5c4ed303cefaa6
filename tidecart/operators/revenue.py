"""Daily revenue per customer segment and its growth."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.expressions import SCALE, amount, growth, units
from .lookup import sum_by_attribute
from .upsert import upsert_add

GROWTH = "crescimento_receita_d-1"


def _with_day(sales):
    return sales.withColumn("data", F.to_date("data_compra"))


def daily_revenue(sales, customers):
    """Revenue and number of sales lines per day and segment; unknown users have a null segment."""
    daily = sum_by_attribute(
        _with_day(sales), customers, "id_usuario", ["segmento_cliente"],
        {
            "receita_total_diaria": F.sum(units("valor_total_compra")),
            "numero_de_pedidos": F.count("id_transacao"),
        },
        group_by=["data"],
    )
    return daily.withColumn("receita_total_diaria", amount(F.col("receita_total_diaria")))


def added(stored, new):
    """Stored totals with those of newly arrived sales added; sums are rounded to what amounts are kept with."""
    both = upsert_add(stored, new, ["data", "segmento_cliente"], ["receita_total_diaria", "numero_de_pedidos"])
    return both.withColumn("receita_total_diaria", F.round("receita_total_diaria", SCALE))


def _by_segment():
    # One row per day, so a segment's partition is as long as the calendar, not as the sales.
    return Window.partitionBy("segmento_cliente").orderBy("data")


def growth_since_last_sale_day(daily):
    """Growth against the previous day on which the segment sold anything."""
    before = F.lag("receita_total_diaria").over(_by_segment())
    return daily.withColumn("receita_dia_anterior", before).withColumn(
        GROWTH, growth(F.col("receita_total_diaria"), F.col("receita_dia_anterior"))
    )


def growth_since_yesterday(daily):
    """Growth against the previous calendar day, null when the segment did not sell on it.

    (data, segmento_cliente) is unique, so the row before is yesterday's or yesterday is absent:
    one window replaces a date-shifted self join.
    """
    days = _by_segment()
    is_yesterday = F.lag("data").over(days) == F.date_sub("data", 1)
    before = F.when(is_yesterday, F.lag("receita_total_diaria").over(days))
    return daily.withColumn("receita_dia_anterior", before).withColumn(
        GROWTH, growth(F.col("receita_total_diaria"), F.col("receita_dia_anterior"))
    )


def join_yesterday(current, history):
    """Growth of some days against stored history, by a date-shifted null-safe left join."""
    yesterday = history.select(
        F.date_add("data", 1).alias("_dia"),
        F.col("segmento_cliente").alias("_segmento"),
        F.col("receita_total_diaria").alias("receita_dia_anterior"),
    )
    same = (F.col("data") == F.col("_dia")) & F.col("segmento_cliente").eqNullSafe(F.col("_segmento"))
    return current.join(yesterday, same, "left").drop("_dia", "_segmento").withColumn(
        GROWTH, growth(F.col("receita_total_diaria"), F.col("receita_dia_anterior"))
    )


def touched_days(changed):
    """Keys whose growth depends on the changed rows: the days themselves and the days after."""
    return changed.select(
        F.explode(F.array(F.col("data"), F.date_add("data", 1))).alias("data"), "segmento_cliente"
    ).distinct()


def rows_of_previous_day(history, changed):
    """History restricted to the day before each changed (day, segment)."""
    wanted = changed.select(
        F.date_sub("data", 1).alias("_dia"), F.col("segmento_cliente").alias("_segmento")
    ).distinct()
    same = (F.col("data") == F.col("_dia")) & F.col("segmento_cliente").eqNullSafe(F.col("_segmento"))
    return history.join(wanted, same, "left_semi")


def trailing_days(daily, days=30, as_of=None):
    """Rows from ``days`` before ``as_of`` (a date column or one-row frame; default today) on."""
    today = F.current_date() if as_of is None else as_of
    return daily.filter(F.col("data") >= F.date_sub(today, days))


def newest_first(daily):
    return daily.orderBy(F.desc("data"), "segmento_cliente")
