"""Distinct orders and carts per day in a stream, as sketches that later batches are united with."""

from ..operators import sketches
from ..sources.batches import BatchFolder
from .adaptive import adaptive


class SketchedDays:
    """Day sketches under ``root``. Each batch stores those of its own rows; a repeated batch or row changes no count."""

    def __init__(self, root):
        self.days = BatchFolder(f"{root}/dias", sketches.DAILY, fold=sketches.folded)

    def add(self, batch, batch_id):
        self.days.write(sketches.daily_sketches(batch), batch_id)

    def read(self, spark):
        """One row for each day so far."""
        return self.days.read(spark)

    def start(self, sales, checkpoints, name="sketched_days", **trigger):
        def run(batch, batch_id):
            with adaptive(batch):
                self.add(batch, batch_id)

        writer = sales.writeStream.queryName(name).foreachBatch(run).option("checkpointLocation", f"{checkpoints}/{name}")
        return (writer.trigger(**trigger) if trigger else writer).start()
