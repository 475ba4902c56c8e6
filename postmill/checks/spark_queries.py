"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill import settings
from postmill.checks import fixtures
from postmill.checks.fixtures import base, bronze, pages, plain_times, table
from postmill.operators import gold, silver
from postmill.operators.embed import embed_posts
from postmill.operators.search import (
    in_group,
    nearest,
    nearest_batch,
    nearest_in_buckets,
    presented,
    search_text,
    search_texts,
    with_bucket,
)
from postmill.operators.vector_index import (
    learn_codebook,
    probes_for,
    read_index,
    search_index,
    search_index_batch,
    share_read,
    write_index,
)
from postmill.plans import jobs, refresh
from postmill.schema import BRONZE_DDL, SILVER_DDL, bronze_columns
from postmill.session import scratch_path
from postmill.sources import listing, tables
from postmill.streaming.landing import ingest_landed_pages

QUERY_TEXT = "signup post about the view of the day and a purchase"
SEARCHED_LABEL = 3
BUCKET_BITS = 4
INDEX_CELLS = 32
# JSON, but no listing.
WRONG_SHAPES = ('{"error":429}', '{"data":{"children":"oops"}}', "[]")
RECALL_AT = 20
DIMENSION = 64
# Written as tables, so that the row counts and files of the jobs themselves are compared.
JOB_TABLES = ("subreddit_daily_stats", "subreddit_summary", "hourly_activity", "top_posts", "author_activity")

QUERIES = {}


def query(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_times(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return run


# Sources and sinks


@query
def listing_flatten(spark, d):
    return listing.flatten_listing(pages(spark, d), fixtures.SITE)


@query
def listing_rejects(spark, d):
    """With the body as title, the posts without a body are incomplete."""
    rejected = listing.rejected_posts(pages(spark, d, title="selftext"))
    return rejected.groupBy("subreddit").agg(F.count("*").alias("rejected"))


def _broken_pages(spark, d):
    """Every third page is cut off in the middle; of the others some are JSON but no listing; the posts of the rest lack their body as title."""
    cut = F.expr("left(body, length(body) div 2)")
    body = F.when(F.col("page_no") % 3 == 0, cut)
    for rest, shape in enumerate(WRONG_SHAPES, 1):
        body = body.when(F.col("page_no") % 7 == rest, shape)
    return pages(spark, d, title="selftext").withColumn("body", body.otherwise(F.col("body")))


@query
def listing_rejects_by_reason(spark, d):
    return listing.rejects(_broken_pages(spark, d))


@query
def rejects_from_job_and_stream(spark, d):
    """The tables of rejects that the job and the stream write, each for a part of the pages, read back."""
    root = scratch_path(spark, "rejects")
    landed = _broken_pages(spark, d)
    jobs.ingest_landed(landed.filter("page_no % 2 = 0"), f"{root}/bronze", f"{root}/rejects")
    tables.write_json_lines(landed.filter("page_no % 2 = 1"), f"{root}/pages")
    ingest_landed_pages(spark, f"{root}/pages", f"{root}/bronze", f"{root}/progress", f"{root}/rejects")
    stored = tables.read_bronze(spark, f"{root}/rejects")
    return stored.groupBy("subreddit", "page_no", "reason").agg(
        F.count("*").alias("rejected"), F.count_if(F.col("source").isNotNull()).alias("with_source")
    )


@query
def bronze_from_job_and_stream(spark, d):
    """Part of the pages by the job, the rest by the stream, all of them read back."""
    root = scratch_path(spark, "both")
    landed = pages(spark, d)
    jobs.ingest_pages(landed.filter("page_no % 2 = 0"), f"{root}/bronze")
    tables.write_json_lines(landed.filter("page_no % 2 = 1"), f"{root}/pages")
    ingest_landed_pages(spark, f"{root}/pages", f"{root}/bronze", f"{root}/progress")
    return tables.read_bronze(spark, f"{root}/bronze").drop("ingestion_timestamp")


@query
def numeric_group_names(spark, d):
    """Groups named by zero-padded numbers, through silver and gold."""
    root = scratch_path(spark, "padded")
    rows = bronze(spark, d).withColumn("subreddit", F.lpad((F.col("score") % 20).cast("string"), 3, "0"))
    tables.append_bronze(rows, f"{root}/bronze")
    jobs.transform_bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver", BRONZE_DDL)
    jobs.transform_silver_to_gold(spark, f"{root}/silver", f"{root}/gold")
    return tables.read_table(spark, f"{root}/gold/subreddit_summary").select("subreddit", "total_posts", "max_score")


@query
def channel_cap(spark, d):
    posts = listing.flatten_listing(pages(spark, d), fixtures.SITE)
    return listing.cap_per_channel(posts, settings.POSTS_PER_CHANNEL).select("subreddit", "post_id", "page_no", "position")


@query
def listing_stream_ingest(spark, d):
    root = scratch_path(spark, "landing")
    tables.write_json_lines(pages(spark, d), f"{root}/pages")
    ingest_landed_pages(spark, f"{root}/pages", f"{root}/bronze", f"{root}/progress")
    return tables.read_bronze(spark, f"{root}/bronze").select("subreddit", "post_id", "title", "created_utc")


@query
def json_lines_scan(spark, d):
    path = scratch_path(spark, "bronze_json")
    tables.write_json_lines(bronze(spark, d), path)
    return tables.read_json_lines(spark, path)


@query
def bronze_append_merge(spark, d):
    path = scratch_path(spark, "bronze")
    fetches = bronze(spark, d)
    second = F.col("ingestion_timestamp") == F.lit(fixtures.SECOND_FETCH).cast("timestamp")
    tables.append_bronze(fetches.filter(~second), path)
    noted = fetches.filter(second).withColumn("note", F.concat(F.lit("seen again: "), "url"))
    tables.append_bronze(noted, path)
    return tables.read_bronze(spark, path)


@query
def silver_partitioned_scan(spark, d):
    path = scratch_path(spark, "silver")
    rows = silver.silver_posts(bronze(spark, d))
    tables.overwrite_table(rows, path, partition_by="subreddit")
    # The partition column comes last on read, so columns are taken by name.
    return tables.read_table(spark, path, rows.schema).select(*rows.columns)


@query
def job_row_counts(spark, d):
    root = scratch_path(spark, "jobs")
    counts = {"bronze": tables.append_bronze(bronze(spark, d), f"{root}/bronze")}
    counts["silver"] = jobs.transform_bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver")
    counts |= jobs.transform_silver_to_gold(spark, f"{root}/silver", f"{root}/gold")
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")


@query
def dedup_removed(spark, d):
    return silver.duplicates_removed(bronze(spark, d))


@query
def project_columns(spark, d):
    """Back into the stated order, from another one and with further columns."""
    shuffled = bronze(spark, d).select("*", F.lit("x").alias("note")).select("note", *reversed(bronze_columns()))
    return shuffled.select(*bronze_columns())


# Silver


@query
def dedup_latest(spark, d):
    return silver.deduplicate_posts(bronze(spark, d))


@query
def clean_text(spark, d):
    return silver.clean_text_fields(bronze(spark, d)).select("post_id", "ingestion_timestamp", "title", "selftext")


@query
def nullify_sentinels(spark, d):
    cleaned = silver.clean_text_fields(bronze(spark, d))
    return cleaned.select("post_id", "ingestion_timestamp", "selftext", "author")


@query
def normalize_flair(spark, d):
    return silver.clean_text_fields(bronze(spark, d)).select("post_id", "ingestion_timestamp", "link_flair_text")


@query
def normalize_booleans(spark, d):
    typed = silver.normalize_types(bronze(spark, d))
    return typed.select("post_id", "ingestion_timestamp", "is_self", "over_18", "spoiler")


@query
def derive_columns(spark, d):
    derived = silver.add_derived_columns(silver.clean_text_fields(bronze(spark, d)))
    return derived.select(
        "post_id", "ingestion_timestamp", "title_length", "selftext_length", "has_selftext", "content",
        "created_date", "created_hour", "day_of_week",
    )


@query
def silver_posts(spark, d):
    return silver.silver_posts(bronze(spark, d))


@query
def silver_from_batches(spark, d):
    """Silver after three bronze batches, each taken in by itself: half of the first fetch, the other half, and the second fetch."""
    root = scratch_path(spark, "batches")
    first, second = fixtures.fetches(spark, d)
    half = F.pmod(F.hash("post_id"), F.lit(2)) == 0
    for batch in (first.filter(half), first.filter(~half), second):
        tables.append_bronze(batch, f"{root}/bronze")
        refresh.refresh_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/state")
    return tables.read_table(spark, f"{root}/silver", SILVER_DDL)


# Gold


def _silver(spark, d):
    return silver.silver_posts(bronze(spark, d))


def _summary(spark, d):
    summary = gold.build_subreddit_summary(_silver(spark, d))
    return summary.withColumn("stddev_score", F.round("stddev_score", 6))


@query
def subreddit_daily_stats(spark, d):
    return gold.build_subreddit_daily_stats(_silver(spark, d))


@query
def subreddit_summary(spark, d):
    return _summary(spark, d)


@query
def hourly_activity(spark, d):
    return gold.build_hourly_activity(_silver(spark, d))


@query
def author_activity(spark, d):
    return gold.build_author_activity(_silver(spark, d))


@query
def top_posts(spark, d):
    return gold.build_top_posts(_silver(spark, d))


@query
def top_posts_stored(spark, d):
    """The gold table as the job writes it from a stored silver table."""
    root = scratch_path(spark, "stored")
    tables.overwrite_table(_silver(spark, d), f"{root}/silver", partition_by="subreddit")
    jobs.transform_silver_to_gold(spark, f"{root}/silver", f"{root}/gold")
    return tables.read_table(spark, f"{root}/gold/top_posts")


def _of_states(spark, d):
    """The rollups over the merged states of three parts of silver."""
    path = scratch_path(spark, "states")
    rows = refresh.state_input(_silver(spark, d))
    for part in range(3):
        refresh.append_states(rows.filter(F.pmod(F.hash("post_id"), F.lit(3)) == part), path, f"{part}")
    return refresh.gold_of_states(spark, path)


@query
def daily_stats_of_states(spark, d):
    return _of_states(spark, d)["subreddit_daily_stats"]


@query
def summary_of_states(spark, d):
    return _of_states(spark, d)["subreddit_summary"].withColumn("stddev_score", F.round("stddev_score", 6))


@query
def author_activity_of_states(spark, d):
    return _of_states(spark, d)["author_activity"]


@query
def bronze_profile(spark, d):
    return gold.bronze_profile(bronze(spark, d))


@query
def silver_profile(spark, d):
    return gold.silver_profile(_silver(spark, d))


@query
def summary_report(spark, d):
    return gold.summary_report(_summary(spark, d))


# Embedding


def _coordinates(vectors: DataFrame, *keys: str) -> DataFrame:
    """Vectors as one row per non-zero coordinate."""
    parts = vectors.select(*keys, F.posexplode("embedding").alias("dim", "weight")).filter("weight <> 0")
    return parts.withColumn("weight", F.col("weight").cast("double"))


@query
def embedding_candidates(spark, d):
    return gold.embedding_candidates(_silver(spark, d))


@query
def embed_text(spark, d):
    vectors = embed_posts(_silver(spark, d), max_chars=settings.EMBED_CHARS).withColumn("document_length", F.length("document"))
    return _coordinates(vectors, "post_id", "document_length")


@query
def embed_whole_text(spark, d):
    documents = table(spark, d, "documents")
    posts = documents.selectExpr("doc_id as post_id", "lang as subreddit", "source as title", "text as content")
    return _coordinates(embed_posts(posts, max_chars=None), "post_id")


# Vector search


def _rounded(results: DataFrame) -> DataFrame:
    return results.withColumns({c: F.round(c, 6) for c in ("similarity", "distance")})


@query
def vector_search(spark, d):
    vectors = table(spark, d, "embeddings")
    return _rounded(nearest(vectors, fixtures.first_vector(spark, d), id_column="vec_id"))


@query
def vector_search_filtered(spark, d):
    vectors = in_group(table(spark, d, "embeddings"), SEARCHED_LABEL, "label")
    return _rounded(nearest(vectors, fixtures.first_vector(spark, d), id_column="vec_id"))


@query
def vector_search_batch(spark, d):
    vectors = table(spark, d, "embeddings")
    found = nearest_batch(vectors, fixtures.label_centroids(spark, d), id_column="vec_id")
    return found.withColumn("similarity", F.round("similarity", 6))


@query
def vector_search_lsh(spark, d):
    path = scratch_path(spark, "bucketed")
    bucketed = with_bucket(table(spark, d, "embeddings"), BUCKET_BITS, DIMENSION)
    tables.overwrite_table(bucketed, path, partition_by="bucket")
    stored = tables.read_table(spark, path, bucketed.schema)
    return _rounded(nearest_in_buckets(stored, fixtures.first_vector(spark, d), BUCKET_BITS, id_column="vec_id"))


@query
def vector_search_recall(spark, d):
    """How many of the exact results the buckets within each radius give."""
    path = scratch_path(spark, "bucketed")
    bucketed = with_bucket(table(spark, d, "embeddings"), BUCKET_BITS, DIMENSION)
    tables.overwrite_table(bucketed, path, partition_by="bucket")
    stored = tables.read_table(spark, path, bucketed.schema)
    target = fixtures.first_vector(spark, d)
    exact = nearest(stored.select("vec_id", "embedding"), target, k=20, id_column="vec_id").select("vec_id")
    found = reduce(
        DataFrame.unionByName,
        [
            nearest_in_buckets(stored, target, BUCKET_BITS, radius, 20, "vec_id").select("vec_id", F.lit(radius).alias("radius"))
            for radius in range(BUCKET_BITS + 1)
        ],
    )
    hits = F.count("*").cast("double")
    return found.join(exact, "vec_id", "left_semi").groupBy("radius").agg((hits / 20).alias("recall"))


def _index(spark, d):
    path = scratch_path(spark, "index")
    vectors = table(spark, d, "embeddings")
    write_index(vectors, path, learn_codebook(vectors, INDEX_CELLS, id_column="vec_id"), "vec_id")
    return read_index(spark, path)


@query
def vector_search_index(spark, d):
    """Over every cell of the index, on whole vectors: the exact search."""
    index, book = _index(spark, d)
    return _rounded(search_index(index, book, fixtures.first_vector(spark, d), short_list=None, id_column="vec_id"))


@query
def vector_index_recall(spark, d):
    """Whether the index finds 0.9 of the exact results in a quarter of the bytes, for every id divisible by 100."""
    index, book = _index(spark, d)
    vectors = table(spark, d, "embeddings")
    asked = vectors.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    probes = probes_for(index, book, id_column="vec_id")
    exact = nearest_batch(vectors, asked, RECALL_AT, id_column="vec_id").select("query_id", "vec_id")
    found = search_index_batch(index, book, asked, RECALL_AT, probes, id_column="vec_id").select("query_id", "vec_id", F.lit(1).alias("hit"))
    both = exact.join(found, ["query_id", "vec_id"], "left")
    read = share_read(index, book, asked, RECALL_AT, probes)
    return both.agg(
        F.count_distinct("query_id").alias("queries"),
        (F.count("hit") >= 0.9 * F.count("*")).alias("recall_reached"),
    ).crossJoin(read.select((F.col("share_read") <= 0.25).alias("quarter_read")))


@query
def vector_search_every_vector(spark, d):
    """Every vector asks for its nearest three."""
    vectors = table(spark, d, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    found = nearest_batch(vectors, asked, 3, id_column="vec_id", queries_per_cell=256)
    return found.withColumn("similarity", F.round("similarity", 6))


@query
def vector_upsert(spark, d):
    vectors = table(spark, d, "embeddings")
    store = tables.KeyedTable(spark, scratch_path(spark, "vectors"))
    store.replace(vectors, "vec_id")
    # Even ids below the row count are replaced, those beyond are new.
    batch = vectors.select((F.col("vec_id") * 2).alias("vec_id"), "embedding", (F.col("label") + 100).alias("label"))
    store.upsert(batch, "vec_id")
    return _coordinates(store.read(), "vec_id", "label")


@query
def semantic_search(spark, d):
    root = scratch_path(spark, "semantic")
    tables.overwrite_table(_silver(spark, d), f"{root}/silver", partition_by="subreddit")
    jobs.build_vector_store(spark, f"{root}/silver", f"{root}/vectors")
    store = tables.KeyedTable(spark, f"{root}/vectors")
    return _rounded(search_text(store.read(), QUERY_TEXT))


@query
def semantic_search_stored(spark, d):
    """The texts of 20 results by their ids, out of a table stored by a hash of the id."""
    root = scratch_path(spark, "semantic")
    tables.overwrite_table(_silver(spark, d), f"{root}/silver", partition_by="subreddit")
    jobs.build_vector_store(spark, f"{root}/silver", f"{root}/vectors")
    return _rounded(search_text(tables.KeyedTable(spark, f"{root}/vectors"), QUERY_TEXT, n_results=20))


@query
def semantic_search_batch(spark, d):
    """The text of the best post of each group asks a stored table for posts like it."""
    root = scratch_path(spark, "semantic")
    tables.overwrite_table(_silver(spark, d), f"{root}/silver", partition_by="subreddit")
    jobs.build_vector_store(spark, f"{root}/silver", f"{root}/vectors")
    stored = tables.read_table(spark, f"{root}/silver", SILVER_DDL)
    asked = gold.embedding_candidates(stored, 1).select(F.col("post_id").alias("query_id"), F.col("content").alias("text"))
    return _rounded(search_texts(tables.KeyedTable(spark, f"{root}/vectors").read(), asked))


@query
def search_presentation(spark, d):
    records = embed_posts(gold.embedding_candidates(_silver(spark, d)))
    return presented(search_text(records, QUERY_TEXT, n_results=20, subreddit_filter=None), fixtures.SITE)
