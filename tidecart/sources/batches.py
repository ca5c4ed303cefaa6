"""Rows of micro-batches in folders of their own, and one manifest of the finished batches.

``<path>/lote=<n>`` holds the rows of batch n. When they are written, an entry named ``<n>`` appears in ``<path>/_lotes``
by a rename, with a small note (JSON) that belongs to the batch: what has an entry is finished, whatever else lies
around is not seen. Running a batch again takes its entry away first and overwrites its folder.

Readers list the manifest once, instead of asking for a success marker in each folder. Finished folders
are merged ``fan`` at a time into ``lote=<a>-<b>``, merged ones again into larger ones, so there are some ``fan`` entries for
each power of ``fan`` batches and each row is rewritten as many times; the newest batch, which may be run again, is left alone.
"""

import json
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from . import folders

MERGED_FILE_BYTES = 128 * 1024 * 1024


def _range(name):
    first, _, last = name.partition("-")
    return int(first), int(last or first)


def _name(entry):
    first, last = entry
    return str(first) if first == last else f"{first}-{last}"


@dataclass(frozen=True)
class BatchFolder:
    path: str
    schema: object
    fan: int = 10
    # Applied to the rows of all folders on reading and to those that are merged.
    fold: Callable[[DataFrame], DataFrame] = lambda df: df

    def _manifest(self):
        return f"{self.path}/_lotes"

    def folder(self, entry):
        return f"{self.path}/lote={_name(entry)}"

    def finished(self, spark, before=None):
        """(first, last) of the finished folders in ascending order; one listing."""
        entries = [_range(n) for n in folders.children(spark, self._manifest()) if n[0].isdigit()]
        entries.sort(key=lambda e: (e[0], -e[1]))
        # While a merge ends, its parts are listed beside it.
        kept = []
        for entry in entries:
            if not kept or entry[1] > kept[-1][1]:
                kept.append(entry)
        return kept if before is None else [e for e in kept if e[0] < before]

    def note(self, spark, before=None):
        """The note of the newest finished batch (before a batch id), {} without one."""
        entries = self.finished(spark, before)
        return json.loads(folders.read_text(spark, f"{self._manifest()}/{_name(entries[-1])}") or "{}") if entries else {}

    def read(self, spark, before=None, since=None):
        """Rows of the finished batches before one id, and from another on."""
        paths = [self.folder(e) for e in self.finished(spark, before) if since is None or e[1] >= since]
        if not paths:
            return self.fold(spark.createDataFrame([], self.schema))
        return self.fold(spark.read.schema(self.schema).parquet(*paths))

    def write(self, df, batch_id, note=None, keep_empty=True):
        """Store the rows of a batch and return their number; only the newest batch can be run again.

        ``note`` may be a function, which is called when the rows are written. A batch without rows may be left out.
        """
        spark, counter = df.sparkSession, Observation()
        entries = self.finished(spark)
        if entries and (batch_id, batch_id) < entries[-1]:
            raise ValueError(f"batch {batch_id} comes after batch {entries[-1][1]} of {self.path}")
        entry = (batch_id, batch_id)
        folders.delete(spark, f"{self._manifest()}/{_name(entry)}")
        df.observe(counter, F.count(F.lit(1)).alias("linhas")).write.mode("overwrite").parquet(self.folder(entry))
        rows = counter.get["linhas"]
        if not rows and not keep_empty:
            folders.delete(spark, self.folder(entry))
            return 0
        folders.write_text(spark, f"{self._manifest()}/{_name(entry)}", json.dumps((note() if callable(note) else note) or {}))
        self._merge(spark, [e for e in entries if e != entry])
        return rows

    def _merge(self, spark, entries):
        """Merges full runs among the batches before the newest one."""
        def tier(entry):
            size, level = entry[1] - entry[0] + 1, 0
            while size >= self.fan:
                size, level = size // self.fan, level + 1
            return level

        while True:
            tiers = [tier(e) for e in entries]
            run = next((i for i in range(len(entries) - self.fan, -1, -1) if len(set(tiers[i:i + self.fan])) == 1), None)
            if run is None:
                return
            parts = entries[run:run + self.fan]
            whole = (parts[0][0], parts[-1][1])
            paths = [self.folder(e) for e in parts]
            files = -(-sum(folders.size(spark, p) for p in paths) // MERGED_FILE_BYTES)
            rows = self.fold(spark.read.schema(self.schema).parquet(*paths))
            rows.repartition(max(1, files)).write.mode("overwrite").parquet(self.folder(whole))
            note = folders.read_text(spark, f"{self._manifest()}/{_name(parts[-1])}")
            folders.write_text(spark, f"{self._manifest()}/{_name(whole)}", note)
            for part in parts:
                folders.delete(spark, f"{self._manifest()}/{_name(part)}")
                folders.delete(spark, self.folder(part))
            entries = entries[:run] + [whole] + entries[run + self.fan:]
