"""Tables by month: what is opened, what is replaced."""

import datetime as dt

from pyspark.sql import functions as F

from tidecart.operators import revenue
from tidecart.plans import history
from tidecart.plans.staging import new_folder
from tidecart.sources import folders
from tidecart.sources.monthly import MonthlyTable, months_later, months_of_quarters, quarter_start

SCHEMA = "data_compra timestamp, n int"
DAY = dt.date


def frame(spark, *rows):
    return spark.createDataFrame([(dt.datetime.fromisoformat(t) if t else None, n) for t, n in rows], SCHEMA)


def values(df):
    return sorted(r.n for r in df.collect())


def test_calendar():
    assert quarter_start(DAY(2024, 3, 31)) == DAY(2024, 1, 1) and quarter_start(DAY(2023, 11, 2)) == DAY(2023, 10, 1)
    assert months_later(DAY(2024, 2, 29), -2) == DAY(2023, 12, 1) and months_later(DAY(2023, 12, 5), 1) == DAY(2024, 1, 1)
    assert months_of_quarters({(2024, 1), (2023, 4)}) == [DAY(2023, 10, 1), DAY(2023, 11, 1), DAY(2023, 12, 1),
                                                          DAY(2024, 1, 1), DAY(2024, 2, 1), DAY(2024, 3, 1)]


def test_only_wanted_months_are_opened(spark):
    table = MonthlyTable(new_folder(spark, "monthly"), "data_compra")
    assert table.newest(spark) is None
    table.write(frame(spark, ("2023-12-31T23:59:59", 1), ("2024-01-01", 2), ("2024-02-29", 3), ("2024-02-01", 4), (None, 5)))
    assert table.months(spark) == [DAY(2023, 12, 1), DAY(2024, 1, 1), DAY(2024, 2, 1)] and table.newest(spark) == DAY(2024, 2, 1)
    opened = lambda df: {f.split("mes=")[1].split("/")[0] for (f,) in df.select(F.input_file_name()).collect()}
    recent = table.read(spark, since=DAY(2024, 1, 1))
    assert values(recent) == [2, 3, 4] and opened(recent) == {"2024-01-01", "2024-02-01"}
    files = lambda df: df._jdf.queryExecution().executedPlan().collectLeaves().head().selectedPartitions().totalNumberOfFiles()
    unadapted = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert files(table.read(spark, months=[DAY(2024, 1, 1)])) == 1
        assert files(table.read(spark, since=DAY(2023, 12, 5), before=DAY(2024, 2, 1))) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", unadapted)
    assert values(table.read(spark)) == [1, 2, 3, 4, 5] and table.read(spark).columns == ["data_compra", "n"]


def test_months_are_replaced_and_the_others_stay(spark):
    table = MonthlyTable(new_folder(spark, "monthly"), "data_compra")
    table.write(frame(spark, ("2024-01-01", 1), ("2024-02-01", 2), ("2024-03-01", 3)))
    kept = sorted(folders.children(spark, f"{table.path}/mes=2024-01-01"))
    table.write(frame(spark, ("2024-02-05", 20), ("2024-02-07", 21)))
    assert values(table.read(spark)) == [1, 3, 20, 21]
    # Rows outside the months that are asked for are not written; a month without rows becomes empty.
    table.write(frame(spark, ("2024-02-05", 30), ("2024-01-09", 99)), [DAY(2024, 2, 1), DAY(2024, 3, 1)])
    assert values(table.read(spark)) == [1, 30] and table.months(spark) == [DAY(2024, 1, 1), DAY(2024, 2, 1)]
    assert sorted(folders.children(spark, f"{table.path}/mes=2024-01-01")) == kept


def test_one_month_computed_again_equals_all_computed_again(spark):
    columns = "id_transacao long, id_usuario long, valor_total_compra double, data_compra timestamp"
    rows = [(i, i % 3, float(i), dt.datetime(2024, 1, 30) + dt.timedelta(days=i % 5)) for i in range(40)]
    customers = spark.createDataFrame([(0, "A"), (1, "B")], "id_usuario long, segmento_cliente string")
    sales, totals = MonthlyTable(new_folder(spark, "sales"), "data_compra"), MonthlyTable(new_folder(spark, "totals"), "data")
    sales.write(spark.createDataFrame(rows[:20], columns))
    history.recompute_months(sales, customers, totals)
    # Late sales of February only.
    late = [r for r in rows[20:] if r[3].month == 2]
    sales.write(spark.createDataFrame([r for r in rows[:20] if r[3].month == 2] + late, columns))
    history.recompute_months(sales, customers, totals, [DAY(2024, 2, 1)])
    grown = lambda daily: sorted(map(tuple, revenue.growth_since_yesterday(daily).collect()), key=repr)
    assert grown(totals.read(spark)) == grown(revenue.daily_revenue(spark.createDataFrame(rows[:20] + late, columns), customers))
