"""The batch pipeline: recompute all history, store it and publish it. Safe to rerun any time."""

from ..operators import carts, products, revenue
from ..schemas import KEYS
from ..sources import lake


def recompute(sales, customers, events, gold_root, store, as_of=None, finished=None):
    """Growth, best sellers and abandonment over all sales before ``as_of`` (default: all).

    Each metric is computed once: what is published is read back from the stored table.
    ``finished`` holds the sales with cart ids where they are not part of ``sales``.
    """
    finished = sales if finished is None else finished
    if as_of is not None:
        sales = sales.filter(sales["data_compra"] < as_of)
        finished = finished.filter(finished["data_compra"] < as_of)
        events = events.filter(events["timestamp_evento"] < as_of)
    spark = sales.sparkSession
    daily = revenue.daily_revenue(sales, customers)
    recent = products.last_complete_quarters(sales)
    metrics = {
        "crescimento_receita": revenue.growth_since_last_sale_day(daily),
        "produtos_mais_vendidos": products.rank_in_quarter(products.units_by_quarter(recent)),
        "taxa_abandono": carts.abandonment_rate(events, finished),
    }
    for name, metric in metrics.items():
        lake.overwrite(metric, f"{gold_root}/{name}")
    stored = {name: lake.current(spark, f"{gold_root}/{name}") for name in metrics}
    growth = revenue.newest_first(stored["crescimento_receita"])
    store.publish(growth, KEYS["batch_growth"], on_empty="raise")
    ranking = products.newest_quarters_first(stored["produtos_mais_vendidos"])
    store.publish(ranking, KEYS["batch_top_products"], on_empty="raise")
    rate = stored["taxa_abandono"].select("taxa_abandono").first()[0]
    store.publish_value(spark, rate, KEYS["batch_abandonment"])


def recompute_months(sales, customers, totals, months=None):
    """Daily totals of some months (default: all there are) again from stored ``sales``; the other months stay.

    Only the sales of those months are read. Growth is not stored with the totals, as the first day of a month is compared
    with the month before: ``revenue.growth_since_yesterday`` adds it on reading, over one row for each day and segment.
    """
    spark = customers.sparkSession
    months = sales.months(spark) if months is None else list(months)
    totals.write(revenue.daily_revenue(sales.read(spark, months=months), customers), months)
