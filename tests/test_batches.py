"""Batch folders with their manifest, and the stream state kept in them, over many batches."""

import datetime as dt
import random

import pytest

from tidecart.plans.staging import new_folder
from tidecart.schemas import KEYS
from tidecart.sources import folders, lake
from tidecart.sources.batches import BatchFolder
from tidecart.sources.snapshots import SnapshotStore
from tidecart.streaming.cart_state import CartState
from tidecart.streaming.windowed import WindowedSales

ALL = {"availableNow": True}


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long").coalesce(1)


def stored(frame):
    return sorted(r.n for r in frame.collect())


def test_batches_are_merged_and_replayed(spark):
    table = BatchFolder(new_folder(spark, "batches"), "n long", fan=3)
    assert stored(table.read(spark)) == [] and table.note(spark) == {}
    for batch in range(16):
        if batch % 7 == 5:
            continue  # a batch without anything to store
        for attempt in (batch + 1000, batch):
            table.write(numbers(spark, attempt), batch, {"rows": batch})
        kept = [b for b in range(batch + 1) if b % 7 != 5]
        assert stored(table.read(spark)) == kept
        assert stored(table.read(spark, before=batch)) == kept[:-1] and table.note(spark) == {"rows": batch}
        assert table.note(spark, batch) == ({"rows": kept[-2]} if batch else {})
        assert table.finished(spark)[-1] == (batch, batch)
    assert len(table.finished(spark)) <= 8
    # Data folders are those of the manifest.
    names = [n for n in folders.children(spark, table.path) if n.startswith("lote=")]
    assert len(names) == len(table.finished(spark))
    with pytest.raises(ValueError):
        table.write(numbers(spark, 1), 3)


def test_unfinished_batches_and_merges_are_not_seen(spark):
    table = BatchFolder(new_folder(spark, "batches"), "n long", fan=4)
    for batch in range(3):
        table.write(numbers(spark, batch), batch)
    numbers(spark, 99).write.parquet(f"{table.path}/lote=3")  # rows without an entry
    assert stored(table.read(spark)) == [0, 1, 2]
    # A merge that ended before its parts were taken away.
    numbers(spark, 0, 1).write.parquet(f"{table.path}/lote=0-1")
    folders.write_text(spark, f"{table.path}/_lotes/0-1", "{}")
    assert table.finished(spark) == [(0, 1), (2, 2)] and stored(table.read(spark)) == [0, 1, 2]


def test_reading_asks_the_file_system_as_often_for_many_batches(spark, monkeypatch):
    table = BatchFolder(new_folder(spark, "batches"), "n long")
    calls = []
    for name in ("children", "exists"):
        monkeypatch.setattr(folders, name, lambda *args, real=getattr(folders, name): calls.append(1) or real(*args))

    def asked():
        calls.clear()
        table.read(spark)
        return len(calls)

    table.write(numbers(spark, 0), 0)
    few = asked()
    for batch in range(1, 23):
        table.write(numbers(spark, batch), batch)
    assert asked() == few == 1
    assert [e for e in table.finished(spark)] == [(0, 9), (10, 19), (20, 20), (21, 21), (22, 22)]


def test_fold_is_applied_to_what_is_merged(spark):
    summed = BatchFolder(new_folder(spark, "batches"), "n long", fan=3, fold=lambda df: df.selectExpr("sum(n) AS n"))
    for batch in range(8):
        summed.write(numbers(spark, batch), batch)
    assert stored(summed.read(spark)) == [28]
    assert spark.read.parquet(f"{summed.path}/lote=0-2").count() == 1


def test_lateness_over_more_than_a_hundred_batches(spark):
    """Every batch against a plain count, one of them run twice; the clock never depends on recent progress only."""
    rng, day, epoch = random.Random(4), dt.timedelta(days=1), dt.datetime(1970, 1, 1)
    metric = WindowedSales(new_folder(spark, "windows"), "data_compra timestamp, valor_total_compra double, n long", delay=2 * day)
    clock, windows, late = None, {}, []
    for batch in range(104):
        rows = [(epoch + day * (0.2 * batch + rng.choice([0, 0.1, -1.5, -2.5, -4])), float(rng.randrange(100)) / 4, 10 * batch + i)
                for i in range(3)]
        if batch == 50:
            rows[0] = (None, 1.0, 500)
        frame = spark.createDataFrame(rows, "data_compra timestamp, valor_total_compra double, n long").coalesce(1)
        for _ in range(2 if batch % 25 == 7 else 1):
            metric.add(frame, batch)
        for time, value, n in rows:
            if time is None or clock is not None and time.replace(hour=0, minute=0, second=0, microsecond=0) + day <= clock:
                late.append(n)
            else:
                start = time.replace(hour=0, minute=0, second=0, microsecond=0)
                total, lines = windows.get(start, (0.0, 0))
                windows[start] = total + value, lines + 1
        clock = max([clock or epoch - 99 * day] + [t - 2 * day for t, _, _ in rows if t])
    assert sorted(r.n for r in metric.late_rows(spark).collect()) == sorted(late) and len(late) > 20
    got = {r.inicio.replace(tzinfo=None): (r.vendas_totais, r.linhas) for r in metric.final(spark).collect()}
    assert got == {s: t for s, t in windows.items() if s + day <= clock}
    got = {r.inicio.replace(tzinfo=None): (r.vendas_totais, r.linhas) for r in metric.open(spark).collect()}
    assert got == {s: t for s, t in windows.items() if s + day > clock}


def test_cart_state_over_a_stream(spark, monkeypatch):
    """Marks in any order over restarts; a batch reads no id that was stored before."""
    events, sales = new_folder(spark, "events"), new_folder(spark, "sales")
    state, checkpoints = CartState(new_folder(spark, "gold"), SnapshotStore(new_folder(spark, "snapshots"))), new_folder(spark, "checkpoint")
    schemas = {events: "id_carrinho string, tipo_evento string", sales: "id_carrinho string"}

    def unread(*args):
        raise AssertionError("stored ids are read again")

    def run(created, finished):
        for path, rows in ((events, [(i, "carrinho_criado") for i in created] + [("zz", "login")]), (sales, [(i,) for i in finished])):
            lake.append(spark.createDataFrame(rows, schemas[path]).coalesce(1), path)
        with monkeypatch.context() as patched:
            patched.setattr(BatchFolder, "read", unread)
            state.start(*[lake.stream_table(spark, p, schemas[p]) for p in (events, sales)], checkpoints, **ALL).awaitTermination()
        return state.store.rows(spark, KEYS["abandonment"], "value string").first().value

    assert run(["a", "b", "b", "c", None], ["x", None]) == "100.00"
    assert run(["a", None], ["a", "b", "a", None]) == "50.00"
    assert run(["x"], []) == "40.00"
    ids = lambda mark: sorted(str(r[0]) for r in state.ids(spark, mark).collect())
    assert ids("criado") == ["None", "a", "b", "c", "x"] and ids("finalizado") == ["a", "b", "x"]
    assert state.counts(spark) == {"criado": 5, "finalizado": 3, "visto": 5}
    # The newest batch run again changes nothing; an older one is refused.
    newest = state.marks.finished(spark)[-1][0]
    again = spark.createDataFrame([("x", "criado")], "id_carrinho string, marca string")
    state.add(again, newest)
    assert state.counts(spark) == {"criado": 5, "finalizado": 3, "visto": 5} and len(ids("criado")) == 5
    with pytest.raises(ValueError):
        state.add(again, newest - 1)


def test_files_written_and_state_read_do_not_grow_with_history(spark):
    events, sales, checkpoints = new_folder(spark, "events"), new_folder(spark, "sales"), new_folder(spark, "checkpoint")
    state = CartState(new_folder(spark, "gold"), SnapshotStore(new_folder(spark, "snapshots")))
    lake.append(spark.createDataFrame([("0",)], "id_carrinho string"), sales)
    seen = []
    for batch, size in enumerate([2000, 2000, 2000, 20]):
        ids = spark.range(batch * 2000, batch * 2000 + size).selectExpr("cast(id AS string) AS id_carrinho", "'carrinho_criado' AS tipo_evento")
        lake.append(ids.coalesce(1), events)
        query = state.start(lake.stream_table(spark, events, ids.schema), lake.stream_table(spark, sales, "id_carrinho string"), checkpoints, **ALL)
        query.awaitTermination()
        progress = [p for p in query.recentProgress if p["numInputRows"]][-1]
        seen.append(progress["stateOperators"][0]["customMetrics"].get("rocksdbGetCount", 0))
    # Lookups follow the batch: 2 for each id, however many are known.
    assert seen[3] <= 100 < seen[2] <= seen[1] + 10
    assert state.counts(spark)["criado"] == 6020
