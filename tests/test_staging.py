"""Staged sales: joined once and in the same way at any size, in loads that streams take in order."""

import pytest
from pyspark.sql import functions as F

from tidecart.plans import staging
from tidecart.sources import folders, tables
from tidecart.sources.monthly import MonthlyTable

SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def copies(spark, folder, *names, **changed):
    """A folder of the named tables, some of them changed."""
    path = staging.new_folder(spark, "tables")
    for name in names:
        df = tables.table(spark, folder, name)
        changed.get(name, lambda df: df)(df).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize("stage", ["sales_messages", "bronze_sales"])
def test_sales_are_joined_once_and_not_shuffled_again(spark, monkeypatch, stage):
    """Each line is read once, whatever the number of loads."""
    read, count = spark.sparkContext.accumulator(0), tables.table(spark, SMALL, "lineitem").count()
    joined = tables.sales

    def counted(spark, folder, *columns, **options):
        def tell(batches):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch
        df = joined(spark, folder, *columns, **options)
        return df.mapInArrow(tell, df.schema).repartition(2, "linha")

    monkeypatch.setattr(tables, "sales", counted)
    path = getattr(staging, stage)(spark, copies(spark, SMALL, "lineitem", "orders", "part", "customer"))
    assert spark.read.parquet(path).count() == count
    assert read.value == count


@pytest.mark.parametrize("stage", ["sales_messages", "bronze_sales"])
def test_loads_come_one_after_the_other(spark, stage):
    folder = copies(spark, SMALL, "lineitem", "orders", "part", "customer")
    path = getattr(staging, stage)(spark, folder)
    dates = []
    for number in range(staging.LOADS):
        where, fs = folders._path(spark, f"{path}/carga={number}")
        dates.append({s.getModificationTime() for s in fs.listStatus(where) if s.getPath().getName().endswith(".parquet")})
    assert all(max(a) < min(b) for a, b in zip(dates, dates[1:]))
    rows = dict(spark.read.parquet(path).groupBy("carga").count().collect())
    assert rows == dict(tables.table(spark, folder, "lineitem").groupBy(F.expr(staging._LOAD.replace("linha", "l_linenumber"))).count().collect())


@pytest.mark.parametrize("wanted, loads", [("false", 0), ("l_linenumber <= 2", 1)])
@pytest.mark.parametrize("stage", ["sales_messages", "bronze_sales"])
def test_loads_without_rows_are_there(spark, stage, wanted, loads):
    folder = copies(spark, SMALL, "lineitem", "orders", "part", "customer", lineitem=lambda df: df.filter(wanted))
    path = getattr(staging, stage)(spark, folder)
    stored = spark.read.parquet(path)
    assert stored.count() == tables.table(spark, folder, "lineitem").count()
    assert stored.select("carga").distinct().count() == loads
    assert staging.files_per_batch(spark, path) >= 1


def test_no_table_is_broadcast_and_dimensions_meet_narrow_rows(spark):
    """What comes to the driver does not depend on how large a dimension may be to be broadcast."""
    plan = plan_of(staging._sales(spark, SMALL, "id_pedido", "id_usuario", "nome_usuario", "item", "linha"))
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 3
    assert "Broadcast" in plan_of(tables.sales(spark, SMALL, "id_pedido", "nome_usuario", "item"))


def test_join_orders_give_the_same_rows(spark):
    """Also for lines without order or part, and orders without customer."""
    folder = copies(spark, SMALL, "lineitem", "orders", "part", "customer",
                    orders=lambda df: df.filter("o_orderkey % 5 > 0"), part=lambda df: df.filter("p_partkey % 3 > 0"),
                    customer=lambda df: df.filter("c_custkey % 4 > 0"))
    columns = ["id_pedido", "linha", "id_usuario", "nome_usuario", "item", "categoria", "id_carrinho"]
    line, order, part, customer = (tables.table(spark, folder, n) for n in ("lineitem", "orders", "part", "customer"))
    plain = line.join(order, line.l_orderkey == order.o_orderkey, "left").join(part, line.l_partkey == part.p_partkey, "left")
    plain = plain.join(customer, order.o_custkey == customer.c_custkey, "left").selectExpr(
        "l_orderkey", "l_linenumber", "o_custkey", "c_name", "p_name", "p_type", "concat_ws('-', o_custkey, to_date(o_orderdate))")
    for strategy in (None, "merge"):
        mine = tables.sales(spark, folder, *columns, strategy=strategy)
        assert mine.exceptAll(plain).isEmpty() and plain.exceptAll(mine).isEmpty()


def test_joins_have_partitions_for_their_lines(spark, monkeypatch):
    conf = lambda: int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = conf()
    monkeypatch.setattr(staging, "_JOINED_BYTES", 1000)
    with staging._join_settings(spark, SMALL):
        assert conf() == -(-folders.size(spark, f"{SMALL}/lineitem.parquet") // 1000) > before
    assert conf() == before


def test_months_are_written_by_the_tasks_that_join_them(spark, monkeypatch):
    """Each partition of the join has a file for each of its months, so its rows were not shuffled again."""
    joined, made = tables.sales, []

    def spread(*given, **options):
        made.append(joined(*given, **options).repartition(3, "linha"))
        return made[-1]

    monkeypatch.setattr(tables, "sales", spread)
    folder = copies(spark, SMALL, "lineitem", "orders")
    stored = staging.monthly_sales(spark, folder)
    expected = made[0].select(F.spark_partition_id(), F.trunc("data_compra", "month")).distinct().count()
    assert len(spark.read.parquet(stored.path).inputFiles()) == expected > len(stored.months(spark))
    columns = made[0].columns
    rows = stored.read(spark).select(columns)
    assert rows.exceptAll(made[0]).isEmpty() and made[0].exceptAll(rows).isEmpty()


def test_months_are_joined_in_tasks_that_need_not_spill(spark, monkeypatch):
    """A task sorts lines, orders and what it writes, and a scan holds its rows to shuffle them: both are cut smaller than by default."""
    names = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
    bytes_of = lambda: [spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(n)) for n in names]
    before, written, write = bytes_of(), [], MonthlyTable.write

    def told(*given, **options):
        written.append(bytes_of())
        write(*given, **options)

    monkeypatch.setattr(MonthlyTable, "write", told)
    staging.monthly_sales(spark, copies(spark, SMALL, "lineitem", "orders"))
    assert all(task <= 32 * 1024 * 1024 < default for task, default in zip(written[0], before))
    assert bytes_of() == before


def test_scans_of_a_join_are_cut_by_size(spark, monkeypatch):
    scans = lambda: tables.table(spark, SMALL, "lineitem").rdd.getNumPartitions()
    size = folders.size(spark, f"{SMALL}/lineitem.parquet")
    monkeypatch.setattr(staging, "_READ_BYTES", size // 8)
    before = scans()
    with staging._join_settings(spark, SMALL):
        assert scans() >= 8 > before
