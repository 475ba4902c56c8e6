"""Bronze rows to silver rows: keep the latest copy, clean, type, derive.

The order of the steps matters: placeholders are recognised after cleaning, and lengths are
taken after placeholders became null.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from postmill import settings
from postmill.functions import text
from postmill.operators.ranking import keep_first
from postmill.schema import FLAGS


# What ``add_derived_columns`` adds.
DERIVED = ("title_length", "selftext_length", "has_selftext", "content", "created_date", "created_hour", "day_of_week")

# What decides between copies of a post before their texts do, the largest first.
LATEST_BY = ("ingestion_timestamp", "score", "num_comments", "upvote_ratio")


def deduplicate_posts(df: DataFrame) -> DataFrame:
    """The latest ingested copy of each post.

    Copies of one fetch share the ingestion time, so all other columns follow as keys: only copies that are
    equal in all of them are left to chance.
    """
    latest = [F.desc(c) for c in LATEST_BY]
    named = ("post_id", *LATEST_BY, "title")
    unordered = (MapType, VariantType)
    rest = [F.asc(f.name) for f in df.schema if f.name not in named and not isinstance(f.dataType, unordered)]
    return keep_first(df, ["post_id"], [*latest, F.asc("title"), *rest])


def clean_text_fields(df: DataFrame) -> DataFrame:
    # Two steps, so that the regular expression runs once per text.
    tidied = df.withColumns({c: text.tidy(c) for c in ("title", "selftext")})
    return tidied.withColumns(
        {
            "selftext": text.null_if_in(F.col("selftext"), settings.BODY_PLACEHOLDERS),
            "author": text.null_if_in(F.col("author"), [settings.AUTHOR_PLACEHOLDER]),
            "link_flair_text": text.flair("link_flair_text"),
        }
    )


def normalize_types(df: DataFrame) -> DataFrame:
    return df.withColumns({name: text.flag(name) for name in FLAGS})


def add_derived_columns(df: DataFrame) -> DataFrame:
    title, body, created = F.col("title"), F.col("selftext"), F.col("created_utc")
    return df.withColumns(
        {
            "title_length": F.length(title),
            "selftext_length": F.coalesce(F.length(body), F.lit(0)),
            "has_selftext": body.isNotNull(),
            "content": text.joined(title, body),
            "created_date": F.to_date(created),
            "created_hour": F.hour(created),
            "day_of_week": F.dayofweek(created),
        }
    )


def silver_posts(bronze: DataFrame, rebalance_by: str | None = None) -> DataFrame:
    """All steps. With ``rebalance_by`` the rows are spread for a table partitioned by that column,
    between the copies' removal and the derived columns, so that no derived text is shuffled."""
    return silver_of_latest(deduplicate_posts(bronze), rebalance_by)


def silver_of_latest(latest: DataFrame, rebalance_by: str | None = None) -> DataFrame:
    """All steps behind the removal of copies."""
    if rebalance_by:
        latest = latest.hint("rebalance", F.col(rebalance_by))
    for step in (clean_text_fields, normalize_types, add_derived_columns):
        latest = latest.transform(step)
    return latest


def duplicates_removed(bronze: DataFrame) -> DataFrame:
    """How many rows keep-latest drops, in one aggregation."""
    # A null id forms a group of its own, as it does in deduplicate_posts.
    kept = F.count_distinct("post_id") + F.max(F.col("post_id").isNull().cast("int"))
    return bronze.agg(F.coalesce(F.count("*") - kept, F.lit(0)).alias("removed"))
