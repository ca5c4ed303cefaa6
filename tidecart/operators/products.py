"""Units sold per quarter and best-seller rankings."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.expressions import quarter_of, year_of


def units_by_quarter(sales):
    """Units per (year, quarter, product); sums combine before the shuffle."""
    return sales.groupBy(
        year_of("data_compra"), quarter_of("data_compra"), "id_produto"
    ).agg(F.sum("quantidade_produto").cast("long").alias("unidades_vendidas"))


def last_complete_quarters(sales, quarters=4, newest=None):
    """Sales in the ``quarters`` before the quarter of the newest sale.

    ``newest`` is a one-row frame with that timestamp, by default taken from ``sales``. Both bounds
    enter the filter as one scalar subquery: no driver round trip, and no sales means no rows.
    """
    newest = sales.agg(F.max("data_compra").alias("newest")) if newest is None else newest
    start = F.date_trunc("quarter", F.col(newest.columns[0]))
    first = F.add_months(start, -3 * quarters).cast("timestamp")
    bounds = newest.select(F.struct(first.alias("first"), start.alias("end"))).scalar()
    bought = F.col("data_compra")
    return sales.filter((bought >= bounds["first"]) & (bought < bounds["end"]))


def rank_in_quarter(units, k=10):
    """The ``k`` best sellers per quarter; equal units are ordered by product id.

    Spark cuts each input partition to ``k`` rows per quarter before the shuffle.
    """
    best = Window.partitionBy("ano", "trimestre").orderBy(F.desc("unidades_vendidas"), "id_produto")
    ranked = units.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("ano", "trimestre", "rank", "id_produto", "unidades_vendidas")


def with_product_names(ranked, catalog):
    """Names are looked up after ranking, for at most k rows per quarter.

    The catalog is first cut to the ranked ids, at most k for each quarter: few enough to be broadcast
    whatever its size, so it is never shuffled.
    """
    names = catalog.select("id_produto", "nome_produto").join(
        F.broadcast(ranked.select("id_produto").distinct()), "id_produto", "left_semi")
    return ranked.join(names, "id_produto", "left").select(
        "ano", "trimestre", "rank", "id_produto", "nome_produto", "unidades_vendidas"
    )


def newest_quarters_first(ranked):
    return ranked.orderBy(F.desc("ano"), F.desc("trimestre"), "rank")


def touched_quarters(sales):
    return sales.select(year_of("data_compra"), quarter_of("data_compra")).distinct()


def in_quarters(units, quarters):
    """Rows of the given quarters only."""
    return units.join(quarters, ["ano", "trimestre"], "left_semi")


def sales_in_quarters(sales, quarters):
    """Sales of the given quarters only, cut before anything is summed."""
    keyed = sales.withColumns({"ano": year_of("data_compra"), "trimestre": quarter_of("data_compra")})
    return keyed.join(quarters, ["ano", "trimestre"], "left_semi").select(*sales.columns)


def available_quarters(ranked):
    return ranked.select("ano", "trimestre").distinct().orderBy("ano", "trimestre")


def available_years(ranked):
    return ranked.select("ano").distinct().orderBy("ano")


def quarter_slice(ranked, year=None, quarter=None):
    """One quarter of a ranking; by default the latest year and the latest quarter in it."""
    if year is None:
        year = ranked.agg(F.max("ano")).scalar()
    in_year = ranked.filter(F.col("ano") == year)
    if quarter is None:
        quarter = in_year.agg(F.max("trimestre")).scalar()
    return in_year.filter(F.col("trimestre") == quarter)
