"""Gold state that survives replays: parquet folders named by the batch that wrote them.

A micro-batch reads the state before it and writes its own folder ``versao=<batch>``. Running the
batch again reads the same earlier folders and overwrites the same one, so nothing is counted
twice; a folder without its success marker is not seen by readers. Rows are partitioned by a
``unidade`` (a year, a quarter, a hash bucket): a batch rewrites only the units it touches, and
the newest folder holding a unit is the current one. Insert-only tables keep the rows of every
folder instead, and may fold them on reading: running sums are stored as one small increment per
batch, not rewritten.
"""

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import folders

_UNIT = "unidade"
# As Spark names the folder of an empty text.
_NAMELESS = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class StateTable:
    path: str
    schema: T.StructType
    unit: Column
    # Every folder adds rows, none replaces the rows of an earlier one.
    insert_only: bool = False
    # Applied to the rows of all folders, for increments that have to be summed.
    fold: Callable[[DataFrame], DataFrame] = lambda df: df

    def versions(self, spark):
        return folders.committed(spark, self.path, "versao=")

    def _sources(self, spark, before):
        """The newest compacted folder in sight and the batch folders after it."""
        seen = lambda n: before is None or n < before
        bases = [n for n in folders.committed(spark, self.path, "base=") if seen(n)]
        base = bases[-1] if bases else None
        later = [n for n in self.versions(spark) if seen(n) and (base is None or n > base)]
        first = [f"{self.path}/base={base}"] if base is not None else []
        return first + [f"{self.path}/versao={n}" for n in later]

    def read(self, spark, before=None, units=None) -> DataFrame:
        """State before a batch (all of it by default), optionally only some units.

        Folder names alone decide what is read. They are bounded by calendar or bucket count, and
        by ``compact`` in the number of versions.
        """
        chosen = {}
        for source in self._sources(spark, before):
            for name in folders.children(spark, source):
                if not name.startswith(f"{_UNIT}="):
                    continue
                if units is not None and name[len(_UNIT) + 1:] not in units:
                    continue
                chosen.setdefault(name, [])
                if not self.insert_only:
                    chosen[name].clear()
                chosen[name].append(f"{source}/{name}")
        paths = [p for group in chosen.values() for p in group]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return self.fold(spark.read.schema(self.schema).parquet(*paths))

    def units_of(self, df):
        """Names of the units a batch touches: a few dozen at most, by design of the unit."""
        return {r[0] for r in df.select(self._unit_text()).distinct().collect()}

    def units_written(self, spark, version):
        """Names of the units that a batch stored; rows whose unit has an empty name (no date) belong to none."""
        names = [n for n in folders.children(spark, f"{self.path}/versao={version}") if n.startswith(f"{_UNIT}=")]
        return {n[len(_UNIT) + 1:] for n in names} - {_NAMELESS}

    def in_units(self, df, units):
        return df.filter(self._unit_text().isin(*units))

    def _unit_text(self):
        return F.coalesce(self.unit.cast("string"), F.lit("nenhuma")).alias(_UNIT)

    def _write(self, df, folder):
        typed = df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema])
        # Rebalance: one file per small unit, and a large unit is split over tasks.
        spread = typed.withColumn(_UNIT, self._unit_text()).hint("rebalance", _UNIT)
        spread.write.mode("overwrite").partitionBy(_UNIT).parquet(folder)

    def write(self, df, version):
        """Store what a batch produced: whole units, or new rows of an insert-only table.

        Only the newest batch can be replayed. An older number means that a query lost its checkpoint and
        counts from 0 again: that is an error, and ``reset`` is the explicit way to start over.
        """
        spark = df.sparkSession
        bases = folders.committed(spark, self.path, "base=")
        newest = max([-1, *self.versions(spark), *bases])
        if version < newest:
            raise ValueError(f"batch {version} comes after batch {newest} of {self.path}; reset() drops what is stored")
        # A replay of a batch that was folded already: its folder and those before it are still there.
        if version in bases:
            folders.delete(spark, f"{self.path}/base={version}")
        self._write(df, f"{self.path}/versao={version}")

    def reset(self, spark, version=0):
        """Forget batch ``version`` and all after it, and everything that was folded with them."""
        for number in (n for n in self.versions(spark) if n >= version):
            folders.delete(spark, f"{self.path}/versao={number}")
        for number in (n for n in folders.committed(spark, self.path, "base=") if n >= version):
            folders.delete(spark, f"{self.path}/base={number}")

    def compact(self, spark, before=None):
        """Fold the folders of finished batches into one; at the start of batch ``before``.

        What was folded is dropped by the next call, when nothing can be replayed from it.
        """
        bases = folders.committed(spark, self.path, "base=")
        versions = [n for n in self.versions(spark) if before is None or n < before]
        if bases and versions and versions[-1] > bases[-1]:
            for old in [n for n in versions if n <= bases[-1]]:
                folders.delete(spark, f"{self.path}/versao={old}")
            for old in bases[:-1]:
                folders.delete(spark, f"{self.path}/base={old}")
        if versions and (not bases or versions[-1] > bases[-1]):
            self._write(self.read(spark, versions[-1] + 1), f"{self.path}/base={versions[-1]}")

    def bootstrap(self, spark):
        """Create the empty table once, so that readers find its schema."""
        if not self.versions(spark) and not folders.committed(spark, self.path, "base="):
            self._write(spark.createDataFrame([], self.schema), f"{self.path}/versao=-1")


def year_unit(column):
    return F.year(column)


def quarter_unit():
    return F.concat_ws("T", "ano", "trimestre")


def bucket_unit(column, buckets=64):
    return F.pmod(F.xxhash64(column), F.lit(buckets))


def summed(keys, amounts):
    """Fold for tables of increments: ``amounts`` of equal keys are added up on reading."""
    return lambda df: df.groupBy(*keys).agg(*[F.sum(a).alias(a) for a in amounts])


def gold_tables(root, schemas, buckets=64):
    """The five gold tables under one folder."""
    def table(name, unit, **kind):
        return StateTable(f"{root}/{name}", schemas[name], unit, **kind)

    tables = [
        table("receita_diaria", year_unit("data")),
        table("produtos_agregados_trimestral", quarter_unit(), insert_only=True,
              fold=summed(["ano", "trimestre", "id_produto"], ["unidades_vendidas"])),
        table("produtos_top10_trimestral", F.col("ano")),
        table("carrinhos_criados", bucket_unit("id_carrinho", buckets), insert_only=True),
        table("carrinhos_finalizados", bucket_unit("id_carrinho", buckets), insert_only=True),
    ]
    return {t.path.rsplit("/", 1)[-1]: t for t in tables}
