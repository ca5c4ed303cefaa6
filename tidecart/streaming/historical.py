"""Historical metrics kept up to date by micro-batches over the bronze tables.

Every batch function reads the state before its batch id and writes the state of that id, so a
replayed batch changes nothing.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import same_keys
from ..operators import carts, products, revenue, upsert
from ..operators.lookup import present
from ..schemas import GOLD, KEYS
from ..sources.state import StateTable, gold_tables
from .adaptive import adaptive
from .cart_state import CartState

COUNTERS = T.StructType([
    T.StructField("carrinhos_criados", T.LongType()),
    T.StructField("carrinhos_convertidos", T.LongType()),
])


class HistoricalMetrics:
    """Gold tables under ``root``, snapshots in ``store``.

    A dimension is a frame, or a function that reads it; the function is called in every batch, so that new
    customers and products are found.
    """

    def __init__(self, root, store, customers=None, catalog=None, as_of=None, buckets=64,
                 compact_every=50):
        self.root = root
        self.store = store
        self.customers = customers
        self.catalog = catalog
        self.as_of = as_of
        self.gold = gold_tables(root, GOLD, buckets)
        self.compact_every = compact_every
        self.cart_state = CartState(f"{root}/fluxo", store)
        self.counters = StateTable(f"{root}/carrinhos_contagem", COUNTERS, F.lit("total"))

    def bootstrap(self, spark):
        for table in self.gold.values():
            table.bootstrap(spark)

    def _compact(self, spark, batch_id, *tables):
        if batch_id and batch_id % self.compact_every == 0:
            for table in tables:
                table.compact(spark, batch_id)

    def daily_revenue(self, totals, batch_id):
        """New totals of some days: replace them and refresh the growth that depends on them."""
        self._store_days(totals, batch_id, lambda before, new: upsert.upsert_replace(before, new, ["data", "segmento_cliente"]))

    def add_sales(self, sales, batch_id):
        """New sales: summed per user and day, then by segment, and added to the totals of their days."""
        self._store_days(revenue.daily_revenue(sales, present(self.customers)), batch_id, revenue.added)

    def _store_days(self, totals, batch_id, merge):
        spark = totals.sparkSession
        table = self.gold["receita_diaria"]
        self._compact(spark, batch_id, table)
        totals = totals.persist()
        try:
            days = revenue.touched_days(totals)
            years = table.units_of(days)
            if not years:
                return
            year_before = table.units_of(days.select(F.add_months("data", -12).alias("data")))
            before = table.read(spark, batch_id, years | year_before).drop(revenue.GROWTH)
            merged = merge(before, totals)
            # Rewritten years see the year before them, so growth on their first day is right.
            refreshed = revenue.growth_since_yesterday(merged)
            table.write(table.in_units(refreshed, years), batch_id)
        finally:
            totals.unpersist()
        latest = revenue.trailing_days(table.read(spark, batch_id + 1), as_of=self.as_of)
        self.store.publish(revenue.newest_first(latest), KEYS["daily_revenue"])

    def top_products(self, sales, batch_id):
        """Add the batch's units to the quarters it touches and rank those quarters again.

        Only the increments of the batch are written, in one pass over its sales, and the names of their folders tell
        the quarters; totals are summed when they are ranked, once.
        """
        spark = sales.sparkSession
        units, top10 = self.gold["produtos_agregados_trimestral"], self.gold["produtos_top10_trimestral"]
        self._compact(spark, batch_id, units, top10)
        if sales.isEmpty():
            return
        units.write(products.units_by_quarter(sales), batch_id)
        quarters = units.units_written(spark, batch_id)
        ranked = products.rank_in_quarter(units.read(spark, batch_id + 1, quarters)).persist()
        named = products.with_product_names(ranked, present(self.catalog)).persist()
        try:
            stored = top10.read(spark, batch_id, top10.units_of(named))
            # Whole quarters give way, so a product that drops out leaves no stale rank behind.
            top10.write(upsert.replace_group(stored, named, ["ano", "trimestre"]), batch_id)
        finally:
            named.unpersist()
            ranked.unpersist()
        latest = products.newest_quarters_first(top10.read(spark, batch_id + 1))
        self.store.publish(latest, KEYS["top_products"])

    def carts(self, marks, batch_id):
        """Register cart ids of a frame that is no stream, and publish the abandonment rate.

        The id tables are only looked up for the ids of the batch, in the hash buckets it
        touches; the rate itself comes from two running counters. Streams keep the ids as state: ``start_carts``.
        """
        spark = marks.sparkSession
        created, finished = self.gold["carrinhos_criados"], self.gold["carrinhos_finalizados"]
        self._compact(spark, batch_id, created, finished, self.counters)
        ids = carts.merge_marks(marks).persist()
        known = None
        try:
            buckets = created.units_of(ids)
            if not buckets:
                return
            known = self._with_history(ids, created.read(spark, batch_id, buckets), "ja_criado")
            known = self._with_history(known, finished.read(spark, batch_id, buckets), "ja_finalizado").persist()
            created.write(known.filter("criado AND NOT ja_criado"), batch_id)
            finished.write(known.filter("finalizado AND NOT ja_finalizado"), batch_id)
            now_sold = F.expr("(criado OR ja_criado) AND (finalizado OR ja_finalizado)")
            gained = known.agg(
                F.count_if(F.expr("criado AND NOT ja_criado")).alias("carrinhos_criados"),
                F.count_if(now_sold & ~F.expr("ja_criado AND ja_finalizado")).alias("carrinhos_convertidos"),
            )
            sums = [F.coalesce(F.sum(f.name), F.lit(0)).alias(f.name) for f in COUNTERS]
            self.counters.write(
                self.counters.read(spark, batch_id).unionByName(gained).agg(*sums), batch_id
            )
        finally:
            ids.unpersist()
            if known is not None:
                known.unpersist()
        self.store.publish(self.abandonment(spark, batch_id + 1), KEYS["abandonment"])

    @staticmethod
    def _with_history(ids, stored, flag):
        """Mark ids already stored. The large table is cut to the batch's ids before the join."""
        hits = stored.join(ids.select("id_carrinho"), same_keys(stored, ids, ["id_carrinho"]), "left_semi")
        hits = hits.select(F.col("id_carrinho").alias("_id"), F.lit(True).alias(flag))
        joined = ids.join(hits, ids["id_carrinho"].eqNullSafe(hits["_id"]), "left").drop("_id")
        return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))

    def abandonment(self, spark, before=None):
        made, sold = F.col("carrinhos_criados"), F.col("carrinhos_convertidos")
        return self.counters.read(spark, before).select(
            carts.two_decimals(carts.rate(made - sold, made)).alias("value")
        )

    # Queries

    def _start(self, name, frame, batch_function, checkpoints, trigger):
        def run(batch, batch_id):
            with adaptive(batch):
                batch_function(batch, batch_id)

        writer = frame.writeStream.queryName(f"historical_{name}").outputMode("update")
        writer = writer.foreachBatch(run)
        writer = writer.option("checkpointLocation", f"{checkpoints}/{name}")
        return (writer.trigger(**trigger) if trigger else writer).start()

    def start_daily_revenue(self, sales, checkpoints, **trigger):
        return self._start("daily_revenue", sales, self.add_sales, checkpoints, trigger)

    def start_top_products(self, sales, checkpoints, **trigger):
        return self._start("top_products", sales, self.top_products, checkpoints, trigger)

    def start_carts(self, events, sales, checkpoints, **trigger):
        """Created and finished carts in one query, their ids kept as keyed state."""
        return self.cart_state.start(events, sales, checkpoints, **trigger)

    def start_all(self, sales, events, checkpoints, **trigger):
        return [
            self.start_daily_revenue(sales, checkpoints, **trigger),
            self.start_top_products(sales, checkpoints, **trigger),
            self.start_carts(events, sales, checkpoints, **trigger),
        ]
