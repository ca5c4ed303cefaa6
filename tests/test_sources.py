"""Ingestion, JDBC access (without a database) and snapshots."""

import datetime as dt
import json

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from tidecart.plans.staging import new_folder
from tidecart.schemas import KEYS
from tidecart.session import shared_folder
from tidecart.sources import folders, footers, id_index, jdbc, lake, snapshots


def rows_of(path, spark):
    return sorted(r[0] for r in spark.read.parquet(path).collect())


def test_ids_out_of_order_are_found_within_the_overlap(spark):
    path = new_folder(spark, "bronze")
    source = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    assert lake.high_water_mark(spark, path, "id") == 0
    assert lake.ingest_increment(source(0, 1, 2, 3, 4, 6), path, "id") == 6
    assert lake.high_water_mark(spark, path, "id") == 6
    assert lake.ingest_increment(source(0, 1, 2, 3, 4, 5, 6), path, "id", overlap=3) == 1
    assert lake.ingest_increment(source(0, 1, 2, 3, 4, 5, 6), path, "id", overlap=3) == 0
    assert rows_of(path, spark) == [0, 1, 2, 3, 4, 5, 6]
    assert lake.ingested(spark, path).columns == ["id"]


def test_late_ids_are_found_by_default_and_missing_ids_refused(spark):
    path = new_folder(spark, "bronze")
    source = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    assert lake.ingest_increment(source(6), path, "id") == 1
    assert lake.ingest_increment(source(5, 6, 7), path, "id") == 2
    assert lake.ingest_increment(source(5, 6, 7), path, "id") == 0
    with pytest.raises(ValueError, match="without id"):
        lake.ingest_increment(source(8, None), path, "id")
    assert rows_of(path, spark) == [5, 6, 7]


def test_sparse_and_negative_ids_give_few_folders(spark):
    path, far = new_folder(spark, "bronze"), 10 ** 12
    ids = [-far, -32_768, -1, 0, 1, 32_768, 32_769, *[far * n for n in range(1, 40)]]
    source = lambda *values: spark.createDataFrame([(i, "x") for i in values], "id long, balde string")
    assert lake.ingest_increment(source(*ids[::2]), path, "id") == len(ids[::2])
    assert lake.ingest_increment(source(*ids, *ids[:3]), path, "id") == len(ids[1::2]) + 1
    assert lake.ingest_increment(source(*ids), path, "id") == 0
    assert lake.ingest_increment(source(far * 5 + 1), path, "id") == 1
    assert sorted({r.id for r in lake.ingested(spark, path).collect()}) == sorted({*ids, far * 5 + 1})
    assert lake.high_water_mark(spark, path, "id") == far * 39
    assert len([n for n in folders.children(spark, path) if n.startswith("lote=")]) == 3


def test_a_load_that_failed_before_its_ids_were_indexed_is_not_repeated(spark, monkeypatch):
    path = new_folder(spark, "bronze")
    lake.ingest_increment(spark.range(10), path, "id")
    with monkeypatch.context() as broken:
        broken.setattr(id_index, "of", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            lake.ingest_increment(spark.range(20), path, "id")
    assert lake.ingest_increment(spark.range(25), path, "id") == 5
    assert sorted(r.id for r in lake.ingested(spark, path).collect()) == list(range(25))


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_full_stretches_are_left_out_at_the_scan_and_no_stored_row_is_read(spark):
    ids, path = id_index.IDS, new_folder(spark, "source")
    spark.range(-3, 9 * ids + 10).selectExpr("id", "id * 2 AS value").write.parquet(path)
    index = id_index.folded(id_index.of(spark.range(1, 8 * ids + 5), "id").unionByName(id_index.of(spark.range(8 * ids + 5, 9 * ids + 5), "id")))
    assert id_index.full_stretches(index, group=2) == [(ids + 1, 9 * ids)]
    assert id_index.full_stretches(index) == []
    fresh = id_index.absent(spark.read.parquet(path), index, "id", group=2)
    assert sorted(r.id for r in fresh.collect()) == [-3, -2, -1, 0, *range(9 * ids + 5, 9 * ids + 10)]
    pushed = plan_of(fresh).split("PushedFilters: [")[1].split("]")[0]
    assert f"LessThan(id,{ids + 1})" in pushed and f"GreaterThan(id,{9 * ids})" in pushed
    assert all(r.mapa is None for r in index.filter("cheio").collect())
    # The same without any stretch, by the joins alone.
    assert sorted(r.id for r in id_index.absent(spark.read.parquet(path), index, "id").collect()) == sorted(r.id for r in fresh.collect())
    stored = new_folder(spark, "stored")
    lake.ingest_increment(spark.range(1, 100), stored, "id")
    table = lake.Increments(stored, spark.range(1).schema, "id")
    read = id_index.absent(spark.read.parquet(path), table.index.read(spark), "id").inputFiles()
    assert any(f"{stored}/_indice/lote=0" in f for f in read) and not any(f"{stored}/lote" in f for f in read)


def test_footers_answer_counts_and_bounds(spark):
    path = new_folder(spark, "orders")
    spark.range(5, 1000).selectExpr("id", "cast(id AS string) AS text").write.parquet(path)
    bounds, counts = footers.id_bounds(spark, path, "id"), footers.row_counts(spark, {"a": path, "b": path})
    assert bounds.collect() == [(5, 999)] and sorted(counts.collect()) == [("a", 995), ("b", 995)]
    assert "PushedAggregation: [MIN(id), MAX(id)]" in plan_of(bounds)
    assert plan_of(counts).split("Initial Plan")[0].count("PushedAggregation: [COUNT(") == 2
    # The caller's session reads as before.
    assert spark.conf.get("spark.sql.sources.useV1SourceList", "parquet") != ""


def test_reload_reports_rows_and_replaces_the_schema(spark):
    root = new_folder(spark, "bronze")
    assert lake.full_reload({"t": spark.range(5)}, root) == {"t": 5}
    assert lake.full_reload({"t": spark.range(3).select(F.col("id").alias("x"))}, root) == {"t": 3}
    assert lake.current(spark, f"{root}/t").columns == ["x"]
    failing = spark.range(3).select(F.raise_error(F.lit("broken source")).alias("x"))
    with pytest.raises(Exception, match="broken source"):
        lake.full_reload({"t": failing}, root)
    begun = lake.current(spark, f"{root}/t")
    assert begun.count() == 3
    assert lake.full_reload({"t": spark.range(7)}, root) == {"t": 7}
    assert begun.count() == 3 and lake.current(spark, f"{root}/t").count() == 7


class FakeDatabase:
    """Stands in for DataFrameReader.jdbc: the SQL goes to temporary views, calls are recorded."""

    def __init__(self, spark):
        self.spark, self.calls = spark, []

    def __call__(self, reader, url, table, **arguments):
        self.calls.append({"table": table, **arguments})
        return self.spark.sql(f"SELECT * FROM {table}")


@pytest.fixture
def database(spark, monkeypatch):
    fake = FakeDatabase(spark)
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, **kw: fake(self, url, table, **kw))
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    yield fake
    spark.conf.unset("spark.sql.ansi.doubleQuotedIdentifiers")


def test_parallel_read_covers_the_id_range(spark, database):
    spark.range(1, 11).createOrReplaceTempView("pedidos")
    assert jdbc.read_by_id(spark, "url", "pedidos", "id", {}, partitions=4).count() == 10
    read = database.calls[-1]
    assert (read["column"], read["lowerBound"], read["upperBound"], read["numPartitions"]) == ("id", 1, 11, 4)


def test_empty_table_is_read_plainly(spark, database):
    spark.range(0).createOrReplaceTempView("vazia")
    assert jdbc.read_by_id(spark, "url", "vazia", "id", {}).count() == 0
    assert "column" not in database.calls[-1]


def test_only_rows_above_the_mark_are_asked_for(spark, database):
    spark.range(1, 11).createOrReplaceTempView("pedidos")
    assert jdbc.read_above(spark, "url", "pedidos", "id", 7, {}, 2).count() == 3
    assert database.calls[-1]["lowerBound"] == 8


def ids_by_predicate(spark, table, predicates):
    return [sorted((r.id for r in spark.sql(f"SELECT id FROM {table} WHERE {p}").collect()), key=lambda i: (i is not None, i)) for p in predicates]


@pytest.mark.parametrize("ids", [[1, 10 ** 18], list(range(50)) + [10 ** 15 + i for i in range(50)], [7, 7, 7, 10 ** 9, None]])
def test_sparse_and_clustered_ids_are_read_in_few_even_parts(spark, database, ids):
    spark.createDataFrame([(i,) for i in ids], "id long").createOrReplaceTempView("esparsa")
    jdbc.read_by_id(spark, "url", "esparsa", "id", {}, rows_per_partition=10)
    predicates = database.calls[-1]["predicates"]
    parts = ids_by_predicate(spark, "esparsa", predicates)
    assert len(parts) <= -(-len(ids) // 10) and max(map(len, parts)) <= 11
    assert sorted((i for part in parts for i in part), key=lambda i: (i is not None, i)) == sorted(ids, key=lambda i: (i is not None, i))


def test_the_number_of_parts_is_bounded(spark, database):
    spark.createDataFrame([(1,), (10 ** 18,)], "id long").createOrReplaceTempView("extremos")
    jdbc.read_by_id(spark, "url", "extremos", "id", {}, rows_per_partition=1)
    assert len(database.calls[-1]["predicates"]) == 2
    assert jdbc.quantiles_query("t", "id", 3, "TABLESAMPLE SYSTEM (1)").count("TABLESAMPLE SYSTEM (1)") == 1
    # A sample that misses the ends still covers every row.
    assert jdbc.range_predicates("id", [5, None, 9, 5]) == ['("id" <= 5 OR "id" IS NULL)', '"id" > 5']
    assert jdbc.range_predicates("id", []) == ["1 = 1"] == jdbc.range_predicates("id", [4])


def test_table_counts(spark, database):
    spark.range(4).createOrReplaceTempView("um")
    spark.range(2).createOrReplaceTempView("dois")
    assert dict(jdbc.table_counts(spark, "url", ["um", "dois"], {}).collect()) == {"um": 4, "dois": 2}


def test_partition_count_follows_the_id_range():
    assert jdbc.partitions_for(1, 1) == 1
    assert jdbc.partitions_for(1, 4_000_001) == 3


@pytest.fixture
def store(spark):
    return snapshots.SnapshotStore(new_folder(spark, "snapshots"))


def test_order_survives_partitions_and_nulls_stay(spark, store):
    frame = spark.createDataFrame(
        [(dt.date(2024, 5, 1), "A", None), (dt.date(2024, 5, 3), "A", 0.5), (dt.date(2024, 5, 2), "B", None)],
        "data date, segmento string, `crescimento_receita_d-1` double",
    ).repartition(3)
    store.publish(frame.orderBy(F.desc("data")), KEYS["daily_revenue"])
    page = store.fetch(spark, KEYS["daily_revenue"]).collect()
    assert len(page) == 1 and page[0].linhas == 3
    assert json.loads(page[0].payload) == [
        {"data": "2024-05-03", "segmento": "A", "crescimento_receita_d-1": 0.5},
        {"data": "2024-05-02", "segmento": "B", "crescimento_receita_d-1": None},
        {"data": "2024-05-01", "segmento": "A", "crescimento_receita_d-1": None},
    ]


def test_long_lists_are_cut_into_ordered_pages(spark):
    ordered = spark.range(0, 5000, 1, 4).repartitionByRange(4, F.desc("id")).sortWithinPartitions(F.desc("id"))
    parts = snapshots.pages(snapshots.json_lines(ordered), "k", page_rows=100).orderBy("pagina").collect()
    assert [(p.pagina, p.linhas) for p in parts] == [(n, 100) for n in range(50)]
    assert [r["id"] for p in parts for r in json.loads(p.payload)] == list(range(4999, -1, -1))


def test_object_shape_and_read_back(spark, store):
    one = spark.createDataFrame([(3,)], "total long")
    store.publish(one, KEYS["carts_created"], "object")
    assert json.loads(store.fetch(spark, KEYS["carts_created"]).first().payload) == {"total": 3}
    # Readers accept both shapes.
    assert store.rows(spark, KEYS["carts_created"], "total long").first().total == 3
    store.publish(one, KEYS["carts_created"], "list")
    assert store.rows(spark, KEYS["carts_created"], "total long").first().total == 3
    with pytest.raises(ValueError):
        store.publish(one, "k", "table")
    store.publish(spark.range(5, 6), "k", "object")
    assert json.loads(store.fetch(spark, "k").first().payload) == {"id": 5}


def test_empty_frames(spark, store):
    none = spark.createDataFrame([], "total long")
    assert store.publish(none, "k") is False
    with pytest.raises(ValueError):
        store.publish(none, "k", on_empty="raise")
    assert store.rows(spark, "k", "total long").count() == 0


def test_single_values(spark, store):
    store.publish_value(spark, 63.5, KEYS["batch_abandonment"])
    assert json.loads(store.fetch(spark, KEYS["batch_abandonment"]).first().payload) == 63.5
    for bad in (None, [1]):
        with pytest.raises(TypeError):
            store.publish_value(spark, bad, "k")


def test_latest_version_wins_and_old_ones_expire(spark):
    store = snapshots.SnapshotStore(new_folder(spark, "snapshots"), hours=1.5)
    for n in range(4):
        store.publish(spark.range(n, n + 1), "k", "object", at=dt.datetime(2024, 5, 1, n))
    assert store.rows(spark, "k", "id long").first().id == 3
    assert store.history(spark, "k").count() == 2
    forever = snapshots.SnapshotStore(new_folder(spark, "snapshots"))
    for n in range(55):
        forever.publish_value(spark, n, "n", at=dt.datetime(2024, 5, 1) + dt.timedelta(seconds=10 * n))
    assert forever.history(spark, "n").count() == 55
    assert forever.value(spark, "n", "long").first().valor == 54
    young = snapshots.within_retention(store.history(spark, "k"), 1, dt.datetime(2024, 5, 1, 3, 30))
    assert young.count() == 1


def test_several_rows_are_no_object_and_torn_pages_are_errors(spark, store):
    with pytest.raises(ValueError, match="several rows"):
        store.publish(spark.range(2), "k", "object")
    torn = spark.createDataFrame([("k", 0, '[{"id": 1}, {"id"', 2, None)], snapshots.SCHEMA)
    with pytest.raises(Exception, match="(?i)malformed"):
        snapshots.decode(torn, "id long").collect()


def test_pages_are_forwarded_by_the_executors(spark):
    target = new_folder(spark, "forwarded").removeprefix("file:")

    def forward(pages):
        import os
        os.makedirs(target, exist_ok=True)
        for page in pages:
            with open(f"{target}/{page.pagina}", "w") as out:
                out.write(page.payload)

    snapshots.SnapshotStore(new_folder(spark, "snapshots"), forward).publish(spark.range(2), "k")
    with open(f"{target}/0") as text:
        assert json.loads(text.read()) == [{"id": 0}, {"id": 1}]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_decimals_keep_all_digits(spark):
    row = spark.sql("SELECT CAST('12345678901234567890.123456789012345678' AS DECIMAL(38, 18)) AS v, CAST(NULL AS DECIMAL(5, 2)) AS n")
    lines = snapshots.json_lines(row)
    assert lines.first().linha == '{"v":12345678901234567890.123456789012345678,"n":null}'
