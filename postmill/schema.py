"""Table schemas, as DDL."""

from pyspark.sql.types import StructType

# Names, order and types of the tables' columns.
BRONZE_DDL = """
    post_id string, subreddit string, title string, selftext string, author string,
    score bigint, upvote_ratio double, num_comments bigint, created_utc timestamp,
    url string, permalink string, is_self string, link_flair_text string,
    over_18 string, spoiler string, awards_received bigint, ingestion_timestamp timestamp
"""

# One landed listing page, and the body's JSON. Keys whose default differs between absent and
# null are variants, since only those keep a JSON null apart; numbers are read as text, since a
# source may quote them, and one that is no number shows only there.
PAGE_DDL = "subreddit string, page_no bigint, ingestion_timestamp timestamp, body string"
POST_DDL = """
    id string, title string, selftext string, author variant, score string, upvote_ratio string,
    num_comments string, created_utc string, url string, permalink string, is_self variant,
    link_flair_text string, over_18 variant, spoiler variant, total_awards_received string
"""
LISTING_DDL = f"data struct<children array<struct<data struct<{POST_DDL}>>>, after string>"

# Silver as the job writes it; stated, so that no partition value is taken for a number.
SILVER_DDL = """
    post_id string, subreddit string, title string, selftext string, author string,
    score bigint, upvote_ratio double, num_comments bigint, created_utc timestamp,
    url string, permalink string, is_self boolean, link_flair_text string,
    over_18 boolean, spoiler boolean, awards_received bigint, ingestion_timestamp timestamp,
    title_length int, selftext_length int, has_selftext boolean, content string,
    created_date date, created_hour int, day_of_week int
"""

FLAGS = ("is_self", "over_18", "spoiler")

TOP_POST_COLUMNS = (
    "subreddit", "rank", "post_id", "title", "author", "score", "num_comments",
    "upvote_ratio", "created_utc", "permalink", "content",
)
EMBED_COLUMNS = ("post_id", "subreddit", "title", "content")


def bronze_schema() -> StructType:
    return StructType.fromDDL(BRONZE_DDL)


def bronze_columns() -> list[str]:
    return bronze_schema().fieldNames()
