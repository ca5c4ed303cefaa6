"""Event-time windows with a lateness rule of their own: what is late is decided once, stored and kept.

The clock of a batch is the newest event time of all batches before it, less the delay. A window is final once the clock
has passed its end; a row whose window is final when its batch begins is late, whatever the engine's watermark was at that
time. The clock is stored with the batch, so it survives restarts, and a batch that is run again finds the
clock it had. Late rows, and rows without a time, are stored whole in a folder beside the windows: they can be
counted, shown and added again, however many batches ago they came.
"""

from datetime import timedelta

from pyspark.sql import functions as F

from ..functions.expressions import amount, total, units
from ..sources.batches import BatchFolder
from .adaptive import adaptive

_WINDOW = "inicio long, unidades long, linhas long"


def windowed_sales(sales, length="1 day", delay="2 days", at="data_compra"):
    """Sales per tumbling window under the engine's watermark, for sinks in append mode.

    A row is dropped when its window was closed by the watermark of the batch before the last one.
    """
    return (
        sales.withWatermark(at, delay).groupBy(F.window(at, length).alias("janela"))
        .agg(total("valor_total_compra").alias("vendas_totais"), F.count(F.lit(1)).alias("linhas"))
        .select(F.col("janela.start").alias("inicio"), F.col("janela.end").alias("fim"),
                "vendas_totais", "linhas")
    )


def _micros(span):
    return span // timedelta(microseconds=1)


class WindowedSales:
    """Totals of tumbling windows under ``root``; windows begin at multiples of ``length`` since 1970 (UTC)."""

    def __init__(self, root, schema, length=timedelta(days=1), delay=timedelta(days=2), at="data_compra", value="valor_total_compra"):
        self.length, self.delay, self.at, self.value = _micros(length), _micros(delay), at, value
        sums = lambda df: df.groupBy("inicio").agg(F.sum("unidades").alias("unidades"), F.sum("linhas").alias("linhas"))
        self.windows = BatchFolder(f"{root}/janelas", _WINDOW, fold=sums)
        self.late = BatchFolder(f"{root}/atrasadas", schema)

    def clock(self, spark, before=None):
        """Event time in microseconds up to which windows are final, None before the first event."""
        return self.windows.note(spark, before).get("relogio")

    def add(self, batch, batch_id):
        """One micro-batch: its rows on time are added to their windows, the others are stored as late."""
        spark, clock = batch.sparkSession, self.clock(batch.sparkSession, batch_id)
        time = F.unix_micros(self.at)
        start = time - F.pmod(time, F.lit(self.length))
        is_late = start.isNull() if clock is None else start.isNull() | (start + self.length <= clock)
        # The value is kept as it is where it is late: it may be what is wrong with the row.
        sums = batch.groupBy(start.alias("inicio"), is_late.alias("atrasada")).agg(
            F.sum(F.when(~is_late, units(self.value))).alias("unidades"), F.count(F.lit(1)).alias("linhas"),
            F.max(time).alias("newest")).persist()
        try:
            seen = sums.agg(F.max("newest").alias("newest"), F.bool_or("atrasada").alias("late")).first()
            if seen.late:
                self.late.write(batch.filter(is_late), batch_id)
            if seen.newest is not None:
                clock = max(seen.newest - self.delay, seen.newest - self.delay if clock is None else clock)
            # Last, as the entry of the windows makes the batch count.
            self.windows.write(sums.filter("NOT atrasada").select("inicio", "unidades", "linhas"), batch_id, {"relogio": clock})
        finally:
            sums.unpersist()

    def _shown(self, windows):
        return windows.select(F.timestamp_micros("inicio").alias("inicio"), F.timestamp_micros(F.col("inicio") + self.length).alias("fim"),
                              amount(F.col("unidades")).alias("vendas_totais"), "linhas")

    def final(self, spark):
        """Windows that no row can change any more."""
        clock = self.clock(spark)
        windows = self.windows.read(spark)
        return self._shown(windows.filter(F.lit(False) if clock is None else F.col("inicio") + self.length <= clock))

    def open(self, spark):
        """Windows that are still counted, as far as they are."""
        clock = self.clock(spark)
        windows = self.windows.read(spark)
        return self._shown(windows if clock is None else windows.filter(F.col("inicio") + self.length > clock))

    def late_rows(self, spark):
        """Every row that came too late or without a time, as it came."""
        return self.late.read(spark)

    def start(self, sales, checkpoints, name="windowed_sales", **trigger):
        def run(batch, batch_id):
            with adaptive(batch):
                self.add(batch, batch_id)

        writer = sales.writeStream.queryName(name).foreachBatch(run).option("checkpointLocation", f"{checkpoints}/{name}")
        return (writer.trigger(**trigger) if trigger else writer).start()
