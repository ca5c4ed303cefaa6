"""State folders: replays, partial rewrites, rewinding, compaction."""

import pytest
from pyspark.sql import functions as F

from tidecart.plans.staging import new_folder
from tidecart.schemas import GOLD
from tidecart.sources import folders
from tidecart.sources.state import StateTable, bucket_unit, gold_tables, quarter_unit, summed

KEYS = ["ano", "trimestre", "id_produto"]


def units(spark, *rows):
    return spark.createDataFrame(list(rows), GOLD["produtos_agregados_trimestral"])


def content(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture
def table(spark):
    return StateTable(new_folder(spark, "t"), GOLD["produtos_agregados_trimestral"], quarter_unit())


@pytest.fixture
def increments(spark):
    return StateTable(new_folder(spark, "i"), GOLD["produtos_agregados_trimestral"], quarter_unit(),
                      insert_only=True, fold=summed(KEYS, ["unidades_vendidas"]))


def test_a_batch_replaces_only_the_units_it_touches(spark, table):
    table.write(units(spark, (2024, 1, 1, 5), (2024, 2, 1, 7)), 0)
    table.write(units(spark, (2024, 2, 2, 9)), 1)
    assert content(table.read(spark)) == [(2024, 1, 1, 5), (2024, 2, 2, 9)]
    assert content(table.read(spark, before=1)) == [(2024, 1, 1, 5), (2024, 2, 1, 7)]
    assert content(table.read(spark, units={"2024T1"})) == [(2024, 1, 1, 5)]
    assert table.units_of(units(spark, (2024, 3, 1, 1), (2024, 3, 2, 1))) == {"2024T3"}


def test_replayed_increment_counts_once(spark, increments):
    increments.write(units(spark, (2024, 1, 1, 5)), 0)
    for _ in range(2):
        increments.write(units(spark, (2024, 1, 1, 2), (2024, 1, 3, 1)), 1)
    assert content(increments.read(spark)) == [(2024, 1, 1, 7), (2024, 1, 3, 1)]


def test_unfinished_folder_is_not_seen(spark, increments):
    increments.write(units(spark, (2024, 1, 1, 5)), 0)
    increments.write(units(spark, (2024, 1, 1, 2)), 1)
    folders.delete(spark, f"{increments.path}/versao=1/_SUCCESS")
    assert content(increments.read(spark)) == [(2024, 1, 1, 5)]


def test_restart_from_batch_zero_is_refused_until_reset(spark, increments):
    for batch in range(3):
        increments.write(units(spark, (2024, 1, 1, 1)), batch)
    increments.compact(spark)
    with pytest.raises(ValueError, match="reset"):
        increments.write(units(spark, (2024, 1, 1, 10)), 0)
    assert content(increments.read(spark)) == [(2024, 1, 1, 3)]
    increments.reset(spark)
    increments.write(units(spark, (2024, 1, 1, 10)), 0)
    assert content(increments.read(spark)) == [(2024, 1, 1, 10)]


def test_compaction_keeps_state_and_replays(spark, increments, table):
    for batch in range(4):
        increments.write(units(spark, (2024, 1, 1, 1), (2024, batch + 1, 2, 1)), batch)
        table.write(units(spark, (2024, 1, 1, batch)), batch)
    before = content(increments.read(spark))
    for t in (increments, table):
        t.compact(spark, before=4)
    assert content(increments.read(spark)) == before
    assert content(table.read(spark)) == [(2024, 1, 1, 3)]
    # Batch 3 may still be replayed: the state before it is intact until batch 4 exists.
    assert content(increments.read(spark, before=3))[0] == (2024, 1, 1, 3)
    increments.write(units(spark, (2024, 1, 1, 1)), 4)
    increments.compact(spark, before=5)
    assert increments.versions(spark) == [4]
    assert content(increments.read(spark))[0] == (2024, 1, 1, 5)
    # Batch 4 fails after its write and is run again.
    increments.write(units(spark, (2024, 1, 1, 1)), 4)
    assert content(increments.read(spark))[0] == (2024, 1, 1, 5)


def test_bootstrap_creates_empty_tables_once(spark):
    gold = gold_tables(new_folder(spark, "gold"), GOLD)
    assert set(gold) == set(GOLD)
    for name, t in gold.items():
        t.bootstrap(spark)
        assert (t.read(spark).count(), t.read(spark).columns) == (0, GOLD[name].fieldNames())
    ids = spark.createDataFrame([("a",), (None,)], "id_carrinho string")
    gold["carrinhos_criados"].write(ids, 0)
    gold["carrinhos_criados"].bootstrap(spark)
    assert gold["carrinhos_criados"].read(spark).count() == 2


def test_hot_unit_is_split_over_tasks(spark):
    """One bucket holding all rows must not be written by one task."""
    t = StateTable(new_folder(spark, "hot"), GOLD["carrinhos_criados"], bucket_unit("id_carrinho", 1),
                   insert_only=True)
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        t.write(spark.range(0, 200000, 1, 8).select(F.sha1(F.col("id").cast("string")).alias("id_carrinho")), 0)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = [n for n in folders.children(spark, f"{t.path}/versao=0/unidade=0") if n.endswith(".parquet")]
    assert len(files) > 1
    assert t.read(spark).count() == 200000
