"""Exact deduplication in three stages that each compare full contents.

1. Local: within a slice of an input partition, equal normalised texts meet in a hash table of contents;
   only one winner of each content goes on with its text.
2. Salted: winners of a digest are dealt over ``salts`` groups and combined within (digest, salt, content),
   so a text held by a third of all rows is never in one task. Unless it is given, the number of salts is the root of the
   number of slices: a text in every slice then has as many winners in a salt as salts, and neither stage outgrows the other.
3. Global: the salt winners, at most ``salts`` for each content, are combined within (digest, content).

Between the stages run links of ids (row to local winner to salt winner to global winner); texts of rows
that have lost are never shuffled.

Defined cases: null text counts as empty; equal means identical after lower-casing A-Z; the largest doc_id
of a group stays, and null ids lose against any id. A repeated row (same doc_id, equal text) is the same
document: it counts in ``group_size`` and is marked like its twin. An empty table gives an empty result;
columns besides the id and the text are ignored.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from .texts import SLICE_BYTES, lower_ascii, record, slices, spare, texts_of

_LOCAL = "doc_id long, local_id long, digest binary, content string, held long"
_LOCAL_ARROW = pa.schema([("doc_id", pa.int64()), ("local_id", pa.int64()), ("digest", pa.binary()),
                          ("content", pa.string()), ("held", pa.int64())])


def sha256(text):
    return hashlib.sha256(text).digest()


def _local_winners(digest):
    def run(batches):
        for batch in slices(batches):
            ids = batch.column(0)
            coded = pc.ascii_lower(texts_of(batch)).dictionary_encode()
            codes, contents = coded.indices.to_numpy(), coded.dictionary
            known = pc.is_valid(ids).to_numpy(zero_copy_only=False)
            values = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
            order = np.lexsort((values, known, codes))
            last = np.append(np.flatnonzero(np.diff(codes[order])), len(order) - 1)
            winner = np.empty(len(contents), dtype=np.int64)
            winner[codes[order[last]]] = order[last]
            wins = winner[codes] == np.arange(len(codes))
            digests = pa.array([digest(c.as_buffer()) for c in contents.cast(pa.binary())], pa.binary())
            yield record(_LOCAL_ARROW, ids, ids.take(pa.array(winner[codes])), digests.take(coded.indices),
                         pc.if_else(pa.array(wins), contents.take(coded.indices), None),
                         np.where(wins, np.bincount(codes, minlength=len(contents))[codes], 0))
    return run


def salts_for(docs, text_column="text"):
    """The root of the number of slices that the texts fill, 16 at least."""
    size = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    return max(16, math.isqrt(size // SLICE_BYTES))


def groups(docs, id_column="doc_id", text_column="text", salts=None, digest=sha256):
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest (binary)."""
    salts = salts or salts_for(docs, text_column)
    rows = (docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
            .mapInArrow(_local_winners(digest), _LOCAL))
    # None of the three is ever null in a winner; said once here, no branch adds a filter that would tell it apart.
    winners = rows.withColumn("salt", F.pmod(F.xxhash64("digest", "local_id"), F.lit(salts)).cast("int")).filter(
        "content IS NOT NULL AND digest IS NOT NULL AND salt IS NOT NULL")

    def combined(frame, own, key):
        alike = Window.partitionBy(*key).orderBy(F.col(own).desc_nulls_last())
        everyone = alike.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return frame.select("*", F.first(own).over(everyone).alias("best"), F.sum("held").over(everyone).alias("size"),
                            F.row_number().over(alike).alias("place"))

    # One exchange of the winners' texts serves both the links and the heads: both need the same columns of it.
    dealt = winners.repartition("digest", "salt")
    salted = combined(dealt, "local_id", ["digest", "salt", "content"])
    heads = salted.filter("place = 1").select(
        "digest", "salt", F.col("best").alias("salt_id"), "content", F.col("size").alias("held"))
    final = combined(heads, "salt_id", ["digest", "content"]).select(
        F.col("digest").alias("d"), F.col("salt").alias("s"), F.col("salt_id").alias("i"), F.col("held").alias("n"),
        F.col("best").alias("keep_id"), F.col("size").alias("group_size"))
    links = salted.select("digest", "salt", "local_id", F.col("best").alias("salt_id"), "size").distinct()
    resolved = links.join(
        final, (F.col("digest") == F.col("d")) & (F.col("salt") == F.col("s"))
        & F.col("salt_id").eqNullSafe(F.col("i")) & (F.col("size") == F.col("n")),
    ).select(F.col("digest").alias("d"), F.col("local_id").alias("i"), "keep_id", "group_size")
    return rows.select("doc_id", "local_id", "digest").join(
        resolved, (F.col("digest") == F.col("d")) & F.col("local_id").eqNullSafe(F.col("i")),
    ).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def keep_one(docs, id_column="doc_id", text_column="text", salts=None):
    """The rows of ``docs`` that stay, with all their columns; of a repeated row one stays."""
    no_id = F.lit(-(2 ** 63))
    id_, digest, own_id, own_digest, place = spare(docs.columns, "id", "digest", "own_id", "own_digest", "place")
    found = groups(docs, id_column, text_column, salts).filter("kept").select(
        F.coalesce("doc_id", no_id).alias(id_), F.col("digest").alias(digest)).distinct()
    text = F.coalesce(F.col(text_column), F.lit(""))
    own = docs.withColumn(own_id, F.coalesce(F.col(id_column).cast("long"), no_id)).withColumn(
        own_digest, F.unhex(F.sha2(lower_ascii(text).cast("binary"), 256)))
    joined = own.join(found, (F.col(own_id) == F.col(id_)) & (F.col(own_digest) == F.col(digest)))
    first = F.row_number().over(Window.partitionBy(own_id, own_digest).orderBy(text_column))
    return joined.withColumn(place, first).filter(F.col(place) == 1).select(*[joined[f"`{c}`"] for c in docs.columns])
