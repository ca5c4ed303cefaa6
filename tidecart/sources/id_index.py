"""Which integer ids a table holds, as one bitmap for each 32,768 neighbouring ids.

A row of the index is (balde, mapa, cheio): the bucket number, its bitmap, and whether it is full, in which case no bitmap is
kept. Dense ids take an eighth of a byte each until their bucket is full, then next to nothing; ids far apart take a
bitmap each, which compresses to a few dozen bytes on disk.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

IDS = 32_768  # ids of a bucket, as Spark's bitmap functions have it
SCHEMA = "balde long, mapa binary, cheio boolean"
#: Buckets that are looked at together when full stretches are sought, and stretches that a filter may name.
GROUP, LONGEST = 4096, 32


def _with_full(frame):
    full = F.col("cheio") | (F.bitmap_count("mapa") == IDS)
    return frame.select("balde", F.when(~full, F.col("mapa")).alias("mapa"), full.alias("cheio"))


def of(df, id_column):
    """The index of the ids of a frame."""
    ids = df.select(F.col(id_column).cast("long").alias("id"))
    maps = ids.groupBy(F.bitmap_bucket_number("id").alias("balde")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("mapa"))
    return _with_full(maps.withColumn("cheio", F.lit(False)))


def folded(rows):
    """Index rows of several loads put together."""
    maps = rows.groupBy("balde").agg(F.bitmap_or_agg(F.coalesce("mapa", F.lit(b""))).alias("mapa"), F.bool_or("cheio").alias("cheio"))
    return _with_full(maps)


def full_stretches(index, longest=LONGEST, group=GROUP):
    """[(first id, last id)] of the longest stretches of full groups of buckets.

    Only numbers of full groups meet in one task, one for each ``group`` * 32,768 ids.
    """
    groups = index.filter("cheio").groupBy(F.floor(F.col("balde") / group).alias("grupo")).count().filter(F.col("count") == group)
    runs = groups.select("grupo", (F.col("grupo") - F.row_number().over(Window.orderBy("grupo"))).alias("run"))
    runs = runs.groupBy("run").agg(F.min("grupo").alias("a"), F.max("grupo").alias("b"))
    found = runs.orderBy(F.desc(F.col("b") - F.col("a")), "a").limit(longest).collect()
    # A bucket holds the ids from (number - 1) * 32,768 + 1 to number * 32,768.
    return [((r.a * group - 1) * IDS + 1, ((r.b + 1) * group - 1) * IDS) for r in found]


def outside(id_column, stretches):
    """A filter that scans and databases take over: ids in none of the stretches."""
    id_ = F.col(id_column)
    return reduce(lambda a, b: a & b, [(id_ < first) | (id_ > last) for first, last in stretches], F.lit(True))


def absent(source, index, id_column, longest=LONGEST, group=GROUP):
    """Rows of ``source`` whose ids are not in the index; no stored row is read.

    Long full stretches are left out by a filter at the source. Other ids in full buckets go by an anti join
    with bucket numbers; only buckets that are partly filled bring their bitmaps to the rows.
    """
    stretches = full_stretches(index, longest, group)
    id_ = F.col(id_column).cast("long")
    rows = source.filter(outside(id_column, stretches)).withColumns(
        {"_balde": F.bitmap_bucket_number(id_), "_bit": F.bitmap_bit_position(id_)})
    full, partly = index.filter("cheio").select(F.col("balde").alias("_balde")), index.filter("NOT cheio").select(F.col("balde").alias("_balde"), "mapa")
    rows = rows.join(full, "_balde", "left_anti").join(partly.withColumnRenamed("mapa", "_mapa"), "_balde", "left")
    byte = F.conv(F.hex(F.substring("_mapa", F.expr("cast(_bit DIV 8 + 1 AS int)"), F.lit(1))), 16, 10).cast("int")
    known = F.coalesce(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1, F.lit(False))
    return rows.filter(~known).select(*source.columns)
