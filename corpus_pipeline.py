"""From raw documents to token ids: language ID, exact and near dedup, decontamination, byte-level BPE.

Each stage works on all rows that its predecessor kept, and its result is stored in the shared folder before
the next one reads it, so a lost executor never repeats an earlier stage.
"""

import uuid

from pyspark.sql import functions as F

from tidecart.llm import decontamination, exact_dedup, language_id, simhash_golay
from tidecart.llm.queries import byte_pairs, documents, language_model
from tidecart.llm.texts import importable
from tidecart.session import shared_folder
from tidecart.sources.tables import table

#: No SQL: several stages cannot be expressed in it. The tests hold run() against brute force.
ORACLE_SQL = None


def identify_language(spark, docs, sf_dir):
    """Rows without a letter, or alike in all languages, go."""
    importable(spark)
    return language_id.keep_told(docs, *language_model(docs))


def drop_exact_copies(spark, docs, sf_dir):
    """Of equal texts the row with the largest doc_id stays."""
    importable(spark)
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Of linked fingerprints the row with the smallest doc_id stays."""
    importable(spark)
    return simhash_golay.keep_one(docs)


def drop_benchmark_leaks(spark, docs, sf_dir):
    """Rows that hold a benchmark item go."""
    importable(spark)
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark, docs, sf_dir):
    """doc_id, n_tokens, ids, and whether the ids decode to the text."""
    importable(spark)
    encoded = byte_pairs(docs.withColumn("text", F.coalesce("text", F.lit(""))))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("byte_bpe", encode),
]


def run(spark, sf_dir):
    work = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs.write.parquet(f"{work}/{number}-{name}")
            docs = spark.read.parquet(f"{work}/{number}-{name}")
    return docs
