"""Gold tables and short reports over silver.

The aggregate tables are listed as data: their keys, and one SQL expression per measure. All
measures have partial aggregates, so a hot group reaches the shuffle as one row per task; the
distinct author count goes through (group, author) first and is spread by author.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill import settings
from postmill.operators.ranking import top_n_per_group
from postmill.schema import EMBED_COLUMNS, TOP_POST_COLUMNS


@dataclass(frozen=True)
class Rollup:
    keys: tuple[str, ...]
    measures: dict[str, str]
    where: str | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        columns = [F.expr(sql).alias(name) for name, sql in self.measures.items()]
        rows = df.filter(self.where) if self.where else df
        return rows.groupBy(*self.keys).agg(*columns)


# The names of the gold tables' columns, and their order.
build_subreddit_daily_stats = Rollup(
    keys=("subreddit", "created_date"),
    measures={
        "post_count": "count(post_id)",
        "avg_score": "avg(score)",
        "avg_comments": "avg(num_comments)",
        "avg_upvote_ratio": "avg(upvote_ratio)",
        "total_score": "sum(score)",
        "total_comments": "sum(num_comments)",
        "avg_title_length": "avg(title_length)",
        "avg_selftext_length": "avg(selftext_length)",
        "text_posts": "count_if(has_selftext)",
        "link_posts": "count_if(not has_selftext)",
    },
)

build_subreddit_summary = Rollup(
    keys=("subreddit",),
    measures={
        "total_posts": "count(post_id)",
        "avg_score": "avg(score)",
        "stddev_score": "stddev_samp(score)",
        "max_score": "max(score)",
        "avg_comments": "avg(num_comments)",
        "max_comments": "max(num_comments)",
        "avg_upvote_ratio": "avg(upvote_ratio)",
        "unique_authors": "count(distinct author)",
        "avg_title_length": "avg(title_length)",
        "nsfw_count": "count_if(over_18)",
    },
)

build_hourly_activity = Rollup(
    keys=("subreddit", "created_hour", "day_of_week"),
    measures={"post_count": "count(post_id)", "avg_score": "avg(score)", "avg_comments": "avg(num_comments)"},
)

build_author_activity = Rollup(
    keys=("subreddit", "author"),
    where="author is not null",
    measures={
        "post_count": "count(post_id)",
        "avg_score": "avg(score)",
        "total_score": "sum(score)",
        "avg_comments": "avg(num_comments)",
    },
)

ROLLUPS = {
    "subreddit_daily_stats": build_subreddit_daily_stats,
    "subreddit_summary": build_subreddit_summary,
    "hourly_activity": build_hourly_activity,
    "author_activity": build_author_activity,
}


def by_score(id_column: str = "post_id"):
    """Best score first, null scores last, equal scores by id."""
    return [F.desc_nulls_last("score"), F.asc(id_column)]


def build_top_posts(silver: DataFrame, top_n: int = settings.TOP_POSTS) -> DataFrame:
    narrow = silver.select(*(c for c in TOP_POST_COLUMNS if c != "rank"))
    return top_n_per_group(narrow, ["subreddit"], by_score(), top_n).select(*TOP_POST_COLUMNS)


def embedding_candidates(silver: DataFrame, top_n: int = settings.EMBED_TOP) -> DataFrame:
    narrow = silver.select(*EMBED_COLUMNS, "score")
    return top_n_per_group(narrow, ["subreddit"], by_score(), top_n).select(*EMBED_COLUMNS)


def _largest(df: DataFrame, size: str, rows: int) -> DataFrame:
    return df.orderBy(F.desc(size), F.asc("subreddit")).limit(rows)


def bronze_profile(bronze: DataFrame, rows: int = settings.REPORT_ROWS) -> DataFrame:
    return _largest(bronze.groupBy("subreddit").count(), "count", rows)


def silver_profile(silver: DataFrame, rows: int = settings.REPORT_ROWS) -> DataFrame:
    profile = Rollup(
        keys=("subreddit",),
        measures={
            "posts": "count(post_id)",
            "avg_score": "round(avg(score), 1)",
            "avg_title_len": "round(avg(title_length), 0)",
            "text_posts": "count_if(has_selftext)",
        },
    )
    return _largest(profile(silver), "posts", rows)


def summary_report(summary: DataFrame, rows: int = settings.REPORT_ROWS) -> DataFrame:
    return _largest(summary, "total_posts", rows)
