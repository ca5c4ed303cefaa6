"""Cart ids as keyed state of the stream: what a batch costs depends on its own rows, not on the history.

Each mark of a cart (created or finished) also marks that the cart was seen at all. The state store keeps the (cart, mark) pairs
that were there, and only a pair's first row gets through; so the stored ids grow by exactly the new ones, and three running
numbers give the rate: carts that are created and finished = created + finished - seen. No stored id is read again.
"""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..operators import carts
from ..schemas import CART_CREATED, KEYS
from ..sources.batches import BatchFolder
from .adaptive import adaptive

CREATED, FINISHED, SEEN = "criado", "finalizado", "visto"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_marks(events, sales):
    """The first (id_carrinho, marca) of each kind, from streams of events and sales.

    A null id created is one cart that is never finished; a null id finished is none.
    """
    created = events.filter(F.col("tipo_evento") == CART_CREATED).select("id_carrinho", F.lit(CREATED).alias("marca"))
    finished = sales.filter(F.col("id_carrinho").isNotNull()).select("id_carrinho", F.lit(FINISHED).alias("marca"))
    marks = created.unionByName(finished)
    both = marks.select("id_carrinho", F.explode(F.array("marca", F.lit(SEEN))).alias("marca"))
    return both.dropDuplicates(["id_carrinho", "marca"])


class CartState:
    """The ids of each kind and their counters under ``root``; the abandonment rate is published after every batch."""

    def __init__(self, root, store):
        self.store = store
        self.marks = BatchFolder(f"{root}/carrinhos", "id_carrinho string, marca string")

    def ids(self, spark, mark):
        """Every cart created, or every cart finished, once."""
        return self.marks.read(spark).filter(F.col("marca") == mark).select("id_carrinho")

    def counts(self, spark, before=None):
        """Created, finished and seen carts; they belong to the entry that makes a batch count."""
        return {CREATED: 0, FINISHED: 0, SEEN: 0} | self.marks.note(spark, before)

    def add(self, marks, batch_id):
        """First marks of a batch; a batch that is run again starts from the same counts."""
        spark, counter = marks.sparkSession, Observation()
        before = self.counts(spark, batch_id)
        counted = marks.observe(counter, *[F.count_if(F.col("marca") == mark).alias(mark) for mark in before])
        self.marks.write(counted.filter(F.col("marca") != SEEN), batch_id,
                         lambda: {mark: n + counter.get[mark] for mark, n in before.items()})
        self.store.publish(self.rate(spark), KEYS["abandonment"])

    def rate(self, spark):
        counts = self.counts(spark)
        sold = counts[CREATED] + counts[FINISHED] - counts[SEEN]
        made = F.lit(counts[CREATED]).cast("long")
        return spark.range(1).select(carts.two_decimals(carts.rate(made - F.lit(sold), made)).alias("value"))

    def start(self, events, sales, checkpoints, name="carts", **trigger):
        """Created and finished carts in one query, so the rate follows a change on either side.

        The state store is RocksDB whatever the session says: the ids are not held in memory.
        """
        marks = first_marks(events, sales)
        conf = marks.sparkSession.conf
        before = conf.get(_PROVIDER, None)
        conf.set(_PROVIDER, _ROCKSDB)

        def run(batch, batch_id):
            with adaptive(batch):
                self.add(batch, batch_id)

        try:
            writer = marks.writeStream.queryName(f"historical_{name}").outputMode("append").foreachBatch(run)
            writer = writer.option("checkpointLocation", f"{checkpoints}/{name}")
            return (writer.trigger(**trigger) if trigger else writer).start()
        finally:
            conf.unset(_PROVIDER) if before is None else conf.set(_PROVIDER, before)
