"""The whole pipeline against plain versions of its stages."""

import brute
import corpus_pipeline
from tidecart.llm import language_id
from tidecart.llm.queries import language_model
from tidecart.sources.tables import table

FOLDER = "/root/testdata/sf0.001"


def test_pipeline_against_plain_stages(spark):
    docs, benchmark = table(spark, FOLDER, "documents"), table(spark, FOLDER, "benchmark")
    told = {r.doc_id for r in language_id.identify(docs, *language_model(docs)).filter("lang_pred <> 'und'").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in told]
    kept = {r[0] for r in brute.exact(rows) if r[3]}
    rows = [r for r in rows if r[0] in kept]
    kept = {component for _, _, component in brute.near(rows)}
    rows = [r for r in rows if r[0] in kept]
    leaking = {doc for doc, _ in brute.leaks(rows, [(r.item_id, r.text) for r in benchmark.collect()])}
    library = brute.byte_pairs()
    expected = {i: (library.encode_ordinary(t), brute.sha(t)) for i, t in rows if i not in leaking}
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id: (r.ids, r.decoded_sha256) for r in found} == expected and len(found) == len(expected)
    assert all(r.n_tokens == len(r.ids) for r in found)


def test_stages_keep_columns_and_clean_rows(spark):
    rows = [(i, f"{chr(97 + i % 26)} clean text number {i} about the house and the garden, with words of its own {i * 7919}", "en", "s", 1, "x")
            for i in range(40)] + [(900, None, "en", "s", 0, "x"), (901, "!!! 123", "en", "s", 7, "x"), (902, None, None, "s", 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns and kept.schema == docs.schema, name
        assert {r.doc_id for r in kept.collect()} >= set(range(40)), name


CLASHING = ["own_id", "OWN_DIGEST", "place", "id", "digest", "leaking", "__own_id", "__place", "__own_digest", "__id", "__digest", "fp", "root", "low",
            "score", "lang_pred", "salt", "node", "kept"]


def test_columns_that_clash_keep_their_values(spark):
    """Each stage keeps the rows it should with all their values, whatever the other columns are called."""
    leak = table(spark, FOLDER, "benchmark").first().text
    texts = [f"{chr(97 + i % 26)} clean text number {i} about the house and the garden, with words of its own {i * 7919}" for i in range(20)]
    texts += [texts[3].upper(), texts[5] + " and", leak, None, "...", texts[7]]
    ids = [*range(20), 40, 41, 42, 43, 44, None]
    rows = [(i, t, "en", "s", 1, *[f"{c}-{n}" for c in CLASHING]) for n, (i, t) in enumerate(zip(ids, texts))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING))
    given = {tuple(r) for r in docs.collect()}
    gone = {"language_id": {43, 44}, "exact_dedup": {3, None}, "simhash_near_dedup": None, "benchmark_decontamination": {42}}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns, name
        found = [tuple(r) for r in kept.collect()]
        assert set(found) <= given and len(found) == len(set(found)), name
        if gone[name] is not None:
            assert {r[0] for r in given} - {r[0] for r in found} == gone[name], name


def test_stages_of_an_empty_table(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0, name
