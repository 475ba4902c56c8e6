"""From raw documents to packed training sequences: five stages, each from one operator.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result is
written as Parquet and read again as the next one's documents. All but the last return the columns of ``docs``.
"""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm import decontaminate, language_id, packing, secrets, simhash
from postmill.llm.common import bound_batches, fresh, may_be_among, quoted, slices, staged, table

ORACLE_SQL = None  # language codes, fingerprints, spans and token ids are beyond SQL


def named(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a name, and the name's column, which none of theirs has.

    A name is the id and the digest of the text, which tells rows without id, or with a repeated one, apart. Names order by id, those without one last.
    """
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    nameless, number = F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0))
    column = fresh(docs.columns, "_name")
    return docs.withColumn(column, F.struct(nameless.alias("nameless"), number.alias("id"), digest.alias("digest"))), column


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with that language in ``lang``.

    The trees learn from the training folds' own labels; rejected are null texts and texts without a letter.
    """
    bound_batches(spark)
    trees = language_id.train(language_id.learners(docs))
    # All other columns as one, so that none meets a name of the prediction; the text goes to the tasks once.
    others = [c for c in docs.columns if c != "text"]
    whole = docs.select(F.struct(*quoted(others)).alias("_row"), F.col("text").alias("_text"))
    kept = language_id.identify(whole, trees, "_text", keep_text=True).filter(F.col("lang_pred") != language_id.UNDETERMINED)
    told = {"lang": F.col("lang_pred"), "text": F.col("_text")}
    return kept.select(*(told.get(c, F.col("_row")[c]).alias(c) for c in docs.columns))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id, once.

    Documents without id, and different texts under one id, are documents of their own; one without id
    stays where no document of its component has one.
    """
    bound_batches(spark)
    rows, name = named(docs)
    found = simhash.near_duplicates(rows.select(name, "text"), id_column=name)
    chosen = F.bool_and(F.col(name) == F.col("component_id")).alias("chosen")
    names = staged(found.groupBy(name).agg(F.count("*").alias("rows"), chosen), "names")
    # Most documents stay and come once: a bitmap tells them, and their texts are not moved.
    key = F.xxhash64(name)
    in_doubt = may_be_among(names.filter("rows > 1 or not chosen").select(key.alias("key")), "key")(key)
    settled = rows.filter(in_doubt).dropDuplicates([name]).join(names.filter("chosen").select(name), name, "left_semi")
    return rows.filter(~in_doubt).unionByName(settled).select(*quoted(docs.columns))


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; those without id are judged by their text alike."""
    bound_batches(spark)
    rows, name = named(docs)
    found = decontaminate.contaminated(rows.select(name, "text"), table(spark, sf_dir, "benchmark"), name)
    leaks = staged(found.withColumnRenamed("doc_id", name), "leaks")
    return rows.join(leaks, name, "left_anti").select(*quoted(docs.columns))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark, and ``n_chars`` counted again."""
    bound_batches(spark)
    spans = fresh(docs.columns, "_found")
    found = secrets.with_spans(docs, name=spans)
    # All other columns as one, so that their names are of no account.
    others = [c for c in docs.columns if c != "text"]
    rows = found.select(F.struct(*quoted(others)).alias("row"), "text", F.col(spans).alias("spans"))

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [
                    secrets.redacted(text, [(s["start"], s["end"]) for s in spans]) if spans else text
                    for text, spans in zip(part["text"].to_pylist(), part["spans"].to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_pydict({"row": part["row"], "text": pa.array(texts, pa.string())})

    cleaned = rows.mapInArrow(redact, rows.select("row", "text").schema)
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return cleaned.select(*(changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    bound_batches(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", with_language),
    ("simhash_near_dedup", without_near_copies),
    ("benchmark_decontamination", without_leaks),
    ("secret_scan", without_secrets),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
