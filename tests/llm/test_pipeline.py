import tracemalloc

import corpus_pipeline
import __spark_entry__ as entry_point
import numpy as np
import pyarrow as pa
import pytest
from postmill.llm import language_id, secrets
from pyspark.sql import functions as F
from test_operators import brute_components, brute_fingerprint, documents, odd_documents

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = documents(spark)
    rows = {r["doc_id"]: r for r in docs.collect()}
    told = corpus_pipeline.with_language(spark, docs, SMALL)
    assert told.columns == docs.columns
    assert {r["doc_id"] for r in told.collect()} == {i for i, r in rows.items() if any(c.isalpha() for c in r["text"] or "")}

    single = corpus_pipeline.without_near_copies(spark, docs, SMALL).collect()
    prints = {i: brute_fingerprint(r["text"]) for i, r in rows.items()}
    group = brute_components(prints.values())
    assert len(single) == len(set(group.values())) == len({group[prints[r["doc_id"]]] for r in single})

    clean = corpus_pipeline.without_secrets(spark, docs, SMALL).collect()
    assert len(clean) == len(rows)
    for r in clean:
        assert r["n_chars"] == len(r["text"])
        assert secrets.find_secrets(rows[r["doc_id"]]["text"]) or r["text"] == rows[r["doc_id"]]["text"]
        assert not [s for s in secrets.find_secrets(r["text"]) if s[0] != "assign"]


def test_leaks_go(spark):
    docs = documents(spark)
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first()["text"]
    planted = spark.createDataFrame([(10**6, f"some words {item} more words", "en", "s", 1)], docs.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.without_leaks(spark, docs.unionByName(planted), SMALL).collect()}
    assert 10**6 not in kept and len(kept) >= 0.9 * docs.count()


def test_run(spark):
    found = entry_point.queries()["pipeline"](spark, SMALL)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.count() > 0 and [n for n, _ in corpus_pipeline.STAGES][1] == "simhash_near_dedup"


def test_odd_input(spark):
    docs = odd_documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
        assert stage(spark, docs, SMALL).count() <= 10
        assert stage(spark, docs.limit(0), SMALL).count() == 0
    # Copies and rows without an id: one of each group stays.
    kept = corpus_pipeline.without_near_copies(spark, docs, SMALL).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["0", "3", "5", "6", "7"]


def test_names_that_clash_and_ids_that_do_not_tell(spark):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first()["text"]
    odd = odd_documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SMALL).columns == odd.columns
    texts = ["the first of two texts", "a wholly different other text", f"words {item} words", "clean prose without any id", "clean prose without any id"]
    ids = [1, 1, None, None, 1]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in zip(ids, texts)], "doc_id long, text string, lang string, source string, n_chars long")

    def rows(df):
        return sorted((r["doc_id"] or 0, r["text"]) for r in df.collect())

    every = sorted((i or 0, t) for i, t in zip(ids, texts))
    # Only the copy without an id goes.
    assert rows(corpus_pipeline.without_near_copies(spark, docs, SMALL)) == [r for r in every if r != (0, texts[3])]
    assert rows(corpus_pipeline.without_leaks(spark, docs, SMALL)) == [r for r in every if r != (0, texts[2])]


def test_columns_of_any_name_come_through(spark):
    """Names that stages use themselves, names with blanks, dashes and dots, and nested ones."""
    docs = documents(spark).limit(40)
    names = ["my col", "a-b", "x.y", "_name", "__name", "_found", "_blob", "_row", "_text", "score", "lang_pred", "fingerprint", "component_id", "item_id"]
    odd = docs.select("*", *(F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names), F.struct(F.col("doc_id").alias("my id")).alias("nested"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SMALL)
        assert out.columns == odd.columns
        rows = out.collect()
        assert rows and all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names) and all(r["nested"]["my id"] == r["doc_id"] for r in rows)


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_bound_the_bytes_of_a_batch(spark, stage):
    limit, docs = "spark.sql.execution.arrow.maxBytesPerBatch", documents(spark)
    long = spark.range(0, 8, 1, 1).select(F.expr("repeat('some words ', 300000)").alias("text"))

    def rows(batches):
        yield from (pa.RecordBatch.from_pydict({"rows": [len(b)]}) for b in batches)

    def most():
        return max(r["rows"] for r in long.mapInArrow(rows, "rows long").collect())

    spark.conf.unset(limit)
    try:
        stage(spark, docs, SMALL)
        assert most() <= 2
        spark.conf.set(limit, "100m")
        stage(spark, docs, SMALL)
        assert most() == 8
    finally:
        spark.conf.unset(limit)


def test_memory_of_a_score_does_not_grow_with_the_languages():
    texts = {f"l{i:02}": f"words of language number {i} are {chr(97 + i % 26) * 3} and {i * i}" for i in range(60)}
    grams, counts = zip(*(np.unique(language_id._own_grams(pa.array([t])), return_counts=True) for t in texts.values()), strict=True)
    keys = np.unique(np.concatenate(grams))
    table = np.zeros((len(keys), len(texts)))
    for i, (g, n) in enumerate(zip(grams, counts, strict=True)):
        table[np.searchsorted(keys, g), i] = n
    trees = language_id.ContextTrees(list(texts), keys, table)
    long = " ".join(texts.values()) * 100
    asked = pa.array(["", long, "words", long])
    tracemalloc.start()
    bits = trees.bits_of(asked)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40 << 20
    assert np.allclose(bits, np.concatenate([trees.bits_of(asked.slice(i, 1)) for i in range(4)]))
    assert np.allclose(bits[2], sum(trees.code_lengths(language_id._own_grams(asked.slice(2, 1)))))
