"""Registered queries of the training-data operators, with SQL where it can express them."""

import public_tokenizers
from pyspark.sql import functions as F

from ..sources.tables import table
from . import (byte_bpe, conversation_repair, decontamination, exact_dedup, fill_in_middle, language_id, license_scan, line_dedup,
               lm_scoring, secret_scan, simhash_golay, token_shards, toxicity)
from .texts import id_bucket, importable


def documents(spark, folder):
    importable(spark)
    return table(spark, folder, "documents")


def language_model(docs):
    return language_id.learn(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op1_language_id(spark, folder):
    docs = documents(spark, folder)
    return language_id.identify(docs, *language_model(docs)).select(
        "doc_id", (id_bucket("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op2_secret_scan(spark, folder):
    docs = documents(spark, folder)
    found = secret_scan.scan(docs, secret_scan.learn(docs))
    return found.select(
        "doc_id", *[secret_scan.number_of("spans", kind).alias(f"n_{kind}") for kind in secret_scan.KINDS],
        F.sha2(secret_scan.written(F.filter("spans", secret_scan.is_base)).cast("binary"), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"))


def op3_lm_scoring(spark, folder):
    bucket = id_bucket("doc_id", 5)
    scores, tokens = lm_scoring.fit_and_score(documents(spark, folder), bucket != 1)
    return scores.select("doc_id", (bucket == 1).alias("held_out"), "n_tokens", "n_known",
                         F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op4_toxicity(spark, folder):
    scored = toxicity.fit_and_score(documents(spark, folder), table(spark, folder, "labels"))
    return scored.select("doc_id", (id_bucket("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def byte_pairs(docs):
    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_byte_bpe(spark, folder):
    return byte_pairs(documents(spark, folder)).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_simhash(spark, folder):
    return simhash_golay.near_duplicates(documents(spark, folder)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_token_shards(spark, folder):
    return token_shards.write_and_read(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


def op8_decontamination(spark, folder):
    return decontamination.contaminated(documents(spark, folder), table(spark, folder, "benchmark"))


def op9_line_dedup(spark, folder):
    return line_dedup.keep_bitmaps(documents(spark, folder), min_documents=10).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(line_dedup.kept_text().cast("binary"), 256).alias("kept_sha256"))


def op10_exact_dedup(spark, folder):
    return exact_dedup.groups(documents(spark, folder)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11_conversation_repair(spark, folder):
    importable(spark)
    return conversation_repair.summaries(conversation_repair.damage(table(spark, folder, "conversations")))


def op12_fill_in_middle(spark, folder):
    turned = fill_in_middle.restore(fill_in_middle.transform(documents(spark, folder)))
    return turned.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                         F.sha2("restored", 256).alias("restored_sha256"))


def op13_license_scan(spark, folder):
    base = F.filter("spans", lambda s: s["base"])
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return license_scan.scan(documents(spark, folder)).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["word"])).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_secret_scan": op2_secret_scan,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_toxicity": op4_toxicity,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_simhash": op6_simhash,
    "op7_token_shards": op7_token_shards,
    "op8_decontamination": op8_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_license_scan": op13_license_scan,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op9_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, i, line,
                   {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
            FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
        frequent AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
        FROM lines LEFT JOIN frequent f ON lines.key = f.key GROUP BY doc_id""",
    "op10_exact_dedup": f"""
        WITH t AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS content FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(content) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY content)""",
    "op12_fill_in_middle": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(cast(doc_id AS varchar), '')) AS h FROM documents),
        numbers AS (
            SELECT doc_id, text, cast(length(text) AS bigint) AS n, ('0x' || substr(h, 1, 8))::bigint AS h1, ('0x' || substr(h, 9, 8))::bigint AS h2,
                   ('0x' || substr(h, 17, 8))::bigint AS h3, ('0x' || substr(h, 25, 8))::bigint AS h4 FROM t),
        cuts AS (
            SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
                        THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
        parts AS (SELECT *, substr(text, 1, a) AS p, substr(text, a + 1, b - a) AS m, substr(text, b + 1) AS s FROM cuts)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts""",
}
