"""The registered queries of the operators, each over its whole table, and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm import (
    decontaminate, html_text, importance, language_id, licenses, lm_score, minhash, packing, prefix_trie, secrets, simhash, sql, topk, toxicity,
)
from postmill.llm.common import table


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", "n_chars")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.best_license(licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return found.select("doc_id", "license", F.round("dice", 9).alias("dice"), "n_notices")


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scored_documents(table(spark, sf_dir, "documents"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def language_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predicted_languages(table(spark, sf_dir, "documents"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.with_counts(secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(turns))


def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_top_k": exact_top_k,
    "op2_license_scan": license_scan,
    "op3_html_main_text": html_main_text,
    "op4_lm_score": lm_scores,
    "op5_decontamination": decontamination,
    "op6_best_fit_packing": best_fit_packing,
    "op7_simhash_near_dedup": simhash_near_dedup,
    "op8_toxicity": toxicity_scores,
    "op9_language_id": language_prediction,
    "op10_secret_scan": secret_scan,
    "op11_minhash_near_dedup": minhash_near_dedup,
    "op12_conversation_prefix_trie": conversation_prefix_trie,
    "op13_importance_resampling": importance_resampling,
}
# Vectors that take no part are left out by the same rules; floor of a double is exact here.
TOP_K_SQL = """
with rows as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scores as (
    select q.vec_id as query_id, c.vec_id,
           list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
    from rows q join rows c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)
),
ranked as (
    select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
    from scores
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

ORACLE: dict[str, str] = {
    "op1_exact_top_k": TOP_K_SQL,
    "op11_minhash_near_dedup": sql.NEAR_DUPLICATES_SQL,
    "op12_conversation_prefix_trie": sql.PREFIX_TRIE_SQL,
    "op13_importance_resampling": sql.IMPORTANCE_SQL,
}
