"""Posts, listing pages and query vectors derived from the given tables, whole."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from postmill.schema import bronze_columns

SITE = "https://example.org"
PAGE_SIZE = 100
FIRST_FETCH = "2024-02-01 00:00:00"
SECOND_FETCH = "2024-02-02 00:00:00"


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its footer is read for the schema once per process."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per event; the body comes from the document and the label of the same id."""
    events, documents, labels = (table(spark, sf_dir, t) for t in ("events", "documents", "labels"))
    joined = events.join(documents, events.event_id == documents.doc_id, "left").join(
        labels, events.event_id == labels.doc_id, "left"
    )
    columns = {
        "post_id": "concat('p', event_id)",
        "subreddit": "event_type",
        "title": "concat('  ', event_type, chr(9), ' post ', event_id, ' ')",
        "selftext": """case event_id % 11 when 0 then '[removed]' when 1 then ''
                       when 2 then ' [deleted] ' else text end""",
        "author": "if(user_id % 10 = 0, '[deleted]', concat('u', user_id))",
        "score": "cast(floor(value) as bigint)",
        "upvote_ratio": "cast(event_id % 129 as double) / 128",
        "num_comments": "cast(regexp_extract(props, '[0-9]+', 0) as bigint)",
        "created_utc": "cast(ts as timestamp)",
        "url": f"concat('{SITE}/', event_id)",
        "permalink": f"concat('{SITE}/c/', event_id)",
        "is_self": "if(n_chars is null, 'False', 'True')",
        "link_flair_text": "if(event_id % 3 = 0, null, concat(' ', upper(lang), ' '))",
        "over_18": "if(toxic = 1, 'True', 'False')",
        "spoiler": "case when event_id % 13 = 0 then 'None' when event_id % 5 = 0 then 'True' else 'False' end",
        "awards_received": "cast(event_id % 4 as bigint)",
        "event_id": "event_id",
    }
    return joined.select(*(F.expr(sql).alias(name) for name, sql in columns.items()))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fetches: all posts, and again every seventh one with a higher score."""
    first, second = (
        F.struct((F.col("score") + more).alias("score"), F.lit(at).cast("timestamp").alias("at"))
        for more, at in ((0, FIRST_FETCH), (1, SECOND_FETCH))
    )
    # One pass over the joined tables makes both fetches.
    copies = F.when(F.col("event_id") % 7 == 0, F.array(first, second)).otherwise(F.array(first))
    rows = base(spark, sf_dir).withColumn("copy", F.explode(copies))
    columns = {"score": F.col("copy.score"), "ingestion_timestamp": F.col("copy.at")}
    return rows.select(*(columns.get(c, F.col(c)).alias(c) for c in bronze_columns()))


def fetches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``bronze``, each fetch apart: for the second one only its own posts are joined."""
    posts = base(spark, sf_dir)

    def fetch(rows: DataFrame, more: int, at: str) -> DataFrame:
        columns = {"score": F.col("score") + more, "ingestion_timestamp": F.lit(at).cast("timestamp")}
        return rows.select(*(columns.get(c, F.col(c)).alias(c) for c in bronze_columns()))

    return fetch(posts, 0, FIRST_FETCH), fetch(posts.filter("event_id % 7 = 0"), 1, SECOND_FETCH)


def pages(spark: SparkSession, sf_dir: str, title: str = "title") -> DataFrame:
    """The same posts as listing pages: JSON bodies of at most PAGE_SIZE posts."""
    post = F.struct(
        F.col("post_id").alias("id"),
        F.col(title).alias("title"),
        "selftext",
        "author",
        "score",
        "upvote_ratio",
        "num_comments",
        (F.unix_micros("created_utc") / 1_000_000).alias("created_utc"),
        "url",
        F.concat(F.lit("/c/"), "event_id").alias("permalink"),
        *(F.col(c).try_cast("boolean").alias(c) for c in ("is_self", "over_18", "spoiler")),
        "link_flair_text",
        F.col("awards_received").alias("total_awards_received"),
    )
    children = F.transform(
        F.array_sort(F.collect_list(F.struct("event_id", post.alias("data")))),
        lambda child: F.struct(child["data"].alias("data")),
    )
    page = F.struct(F.struct(children.alias("children"), F.lit(None).cast("string").alias("after")).alias("data"))
    return (
        base(spark, sf_dir)
        .groupBy("subreddit", F.floor(F.col("event_id") / PAGE_SIZE).alias("page_no"))
        .agg(F.to_json(page, {"ignoreNullFields": "false"}).alias("body"))
        .withColumn("ingestion_timestamp", F.lit(FIRST_FETCH).cast("timestamp"))
    )


def first_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    """The vector with the lowest id, as the query of a single search."""
    vectors = table(spark, sf_dir, "embeddings")
    return list(vectors.agg(F.min_by("embedding", "vec_id")).head()[0])


def label_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query vector per label: the mean of its vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    mean = Summarizer.mean(array_to_vector("embedding"))
    return vectors.groupBy(F.col("label").alias("query_id")).agg(vector_to_array(mean).alias("embedding"))


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the SQL side has them."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned}) if zoned else df
