"""Line deduplication that returns keep bitmaps instead of texts; DataFrame functions only.

Lines become (128-bit hash of the line's key, document, position), range-partitioned by hash and document
and sorted within partitions by hash, document and position. A line of a third of all documents therefore
spreads over many partitions, and the first occurrence in each document is the first row of a sorted run.
Documents for each hash are then counted from first occurrences with map-side combination.

Defined cases: null or empty text is one empty line. A key is the line without white space at both ends
(space, tab to carriage return), A-Z lower-cased; empty keys never count. A document is a distinct
(doc_id, text); repeated rows count once and get the same bitmap. Null ids are documents like any other.
An empty table gives an empty result.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .texts import lower_ascii, text_or_empty

WHITE = " \t\n\x0b\f\r"
_DOCUMENT = ["doc", "text_hash"]
_KEY = ["h1", "h2"]


def _documents(docs, id_column, text_column):
    text = text_or_empty(text_column)
    return docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("doc"),
                       F.xxhash64(text).alias("text_hash"), text.alias("text"))


def hashed_lines(docs, id_column="doc_id", text_column="text"):
    """Lines with a key: doc, text_hash, position, h1, h2."""
    documents = _documents(docs, id_column, text_column)
    lines = documents.select(*_DOCUMENT, F.posexplode(F.split("text", "\n")).alias("position", "line"))
    keyed = lines.select(*_DOCUMENT, "position", lower_ascii(F.btrim("line", F.lit(WHITE))).alias("key"))
    return keyed.filter("key <> ''").select(
        *_DOCUMENT, "position", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def drop_words(docs, min_documents=10, id_column="doc_id", text_column="text"):
    """For documents that lose lines: doc, text_hash, n_dropped, drops (map: 64-line block -> bits that go).

    Blocks that keep all their lines are left out, so a bitmap is as small as its drops.
    """
    lines = hashed_lines(docs, id_column, text_column)
    spread = lines.repartitionByRange(*_KEY, *_DOCUMENT).sortWithinPartitions(*_KEY, *_DOCUMENT, "position")
    first = F.row_number().over(Window.partitionBy(*_KEY, *_DOCUMENT).orderBy("position"))
    frequent = (spread.withColumn("place", first).filter("place = 1")
                .groupBy(*_KEY).agg(F.count("*").alias("n")).filter(F.col("n") >= min_documents).select(*_KEY))
    dropped = spread.join(frequent, _KEY, "left_semi").select(*_DOCUMENT, "position").distinct()
    words = dropped.groupBy(*_DOCUMENT, F.expr("position div 64").cast("int").alias("block")).agg(
        F.expr("bit_or(shiftleft(1L, cast(position % 64 AS int)))").alias("bits"), F.count("*").alias("n"))
    return words.groupBy(*_DOCUMENT).agg(
        F.sum("n").alias("n_dropped"), F.map_from_entries(F.collect_list(F.struct("block", "bits"))).alias("drops"))


def keep_bitmaps(docs, min_documents=10, id_column="doc_id", text_column="text"):
    """One row per row of ``docs``: doc_id, text, n_lines, n_dropped, keep.

    ``keep`` maps a block of 64 lines to its keep bits; a missing block keeps all its lines.
    """
    documents = _documents(docs, id_column, text_column)
    drops = drop_words(docs, min_documents, id_column, text_column)
    return documents.join(drops, _DOCUMENT, "left").select(
        "doc_id", "text", (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"),
        F.transform_values("drops", lambda _, bits: F.bitwise_not(bits)).alias("keep"))


def kept_text():
    """The kept lines of ``text`` under ``keep``, joined by line feeds."""
    return F.expr("""CASE WHEN keep IS NULL THEN text ELSE array_join(filter(split(text, '\n'), (line, i) ->
        (shiftright(coalesce(element_at(keep, cast(i div 64 AS int)), -1L), cast(i % 64 AS int)) & 1L) = 1L), '\n') END""")
