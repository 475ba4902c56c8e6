"""Listing pages to bronze rows."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill import settings
from postmill.operators.ranking import top_n_per_group
from postmill.schema import FLAGS, LISTING_DDL, bronze_columns


NUMBERS = ("score", "upvote_ratio", "num_comments", "created_utc", "total_awards_received")


def _number(key: str) -> Column:
    return F.col(key).try_cast("double")


def _whole(key: str) -> Column:
    """As a bigint: exactly where it is written as one, else by way of a double (``7.0``, ``1e3``)."""
    return F.coalesce(F.col(key).try_cast("bigint"), _number(key).try_cast("bigint"))


def _count(key: str) -> Column:
    return F.coalesce(_whole(key), F.lit(0))


def _unreadable() -> Column:
    """Whether a number is there and cannot be read as one, or is too large for its column."""
    wholes = [key for key in NUMBERS if key not in ("upvote_ratio", "created_utc")]
    bad = [F.col(key).isNotNull() & _number(key).isNull() for key in NUMBERS]
    bad += [F.col(key).isNotNull() & _whole(key).isNull() for key in wholes]
    return reduce(Column.__or__, bad)


def _text_of(key: str, absent: str, null: str | None) -> Column:
    """A variant key as text, with its defaults for an absent key and for a JSON null."""
    value = F.col(key)
    text = F.coalesce(F.try_variant_get(value, "$", "string"), F.lit(absent))
    return F.when(~F.coalesce(F.is_variant_null(value), F.lit(False)), text).otherwise(F.lit(null))


def _flag_text(key: str) -> Column:
    """'True'/'False'; 'None' for a null; 'False' when the key is absent."""
    text = _text_of(key, absent="False", null="None")
    return F.when(text.isin("true", "false"), F.initcap(text)).otherwise(text)


def landed_posts(pages: DataFrame, site: str = settings.SITE) -> DataFrame:
    """All that landed, in one parse: every post as a bronze row with ``page_no`` and ``position``, and every page without posts to read.

    ``pages`` has subreddit, page_no, ingestion_timestamp and the JSON ``body``. The group is
    the one that was asked for, not the one named in the post. A number may be quoted; one that is absent
    or null becomes 0.

    ``reason`` is null for what bronze takes. Otherwise it is "page" (no body, or no JSON), "listing" (JSON without a list of posts),
    "number" (one that cannot be read) or "incomplete" (no id, title or creation time), and ``source`` has the
    page's body or the post as JSON. An empty list of posts is no fault and leaves no row.
    """
    page = ["subreddit", "page_no", "ingestion_timestamp"]
    read = pages.select(*page, "body", F.from_json("body", LISTING_DDL)["data"]["children"].alias("children"))
    fault = F.when(F.try_parse_json("body").isNull(), "page").otherwise("listing")
    read = read.select(
        *page,
        F.when(F.col("children").isNull(), fault).alias("page_fault"),
        F.when(F.col("children").isNull(), F.col("body")).alias("body"),
        F.posexplode_outer("children").alias("position", "child"),
    )
    # Where a list is empty, neither a fault nor a position is left.
    read = read.filter("page_fault is not null or position is not null")
    posts = read.select(*page, "page_fault", "body", "position", "child.data.*", F.col("child.data").alias("post"))
    columns = {
        "post_id": F.col("id"),
        "selftext": F.nullif("selftext", F.lit("")),
        "author": _text_of("author", absent=settings.AUTHOR_PLACEHOLDER, null=None),
        "score": _count("score"),
        "upvote_ratio": F.coalesce(_number("upvote_ratio"), F.lit(0.0)),
        "num_comments": _count("num_comments"),
        "created_utc": F.timestamp_micros(F.round(_number("created_utc") * 1_000_000).try_cast("bigint")),
        "permalink": F.concat(F.lit(site), "permalink"),
        **{key: _flag_text(key) for key in FLAGS},
        "awards_received": _count("total_awards_received"),
    }
    flat = posts.select(
        *(columns.get(c, F.col(c)).alias(c) for c in bronze_columns()),
        "page_no", "position", "page_fault", "body", "post", _unreadable().alias("unreadable"),
    )
    missing = F.col("post_id").isNull() | F.col("title").isNull() | F.col("created_utc").isNull()
    reason = F.coalesce("page_fault", F.when(F.col("unreadable"), "number").when(missing, "incomplete"))
    flat = flat.withColumn("reason", reason)
    source = F.coalesce("body", F.when(F.col("reason").isNotNull(), F.to_json("post")))
    return flat.withColumn("source", source).drop("page_fault", "body", "post", "unreadable")


def flatten_listing(pages: DataFrame, site: str = settings.SITE) -> DataFrame:
    """The posts that bronze takes, with ``page_no`` and ``position``."""
    return landed_posts(pages, site).filter("reason is null").drop("reason", "source")


def rejected_posts(pages: DataFrame) -> DataFrame:
    """The posts ``flatten_listing`` leaves out, to count or to inspect."""
    return landed_posts(pages).filter("reason in ('number', 'incomplete')")


def reject_rows(landed: DataFrame) -> DataFrame:
    """The rows of a table of rejects, out of ``landed_posts``."""
    return landed.filter("reason is not null").select("subreddit", "page_no", "ingestion_timestamp", "position", "reason", "source")


def rejects(pages: DataFrame) -> DataFrame:
    """What ingestion leaves out, by group: subreddit, reason and how many."""
    return reject_rows(landed_posts(pages)).groupBy("subreddit", "reason").agg(F.count("*").alias("rejected"))


def cap_per_channel(posts: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` posts of each channel and fetch, in page order."""
    fetch = ["subreddit", "ingestion_timestamp"]
    order = [F.asc("page_no"), F.asc("position")]
    return top_n_per_group(posts, fetch, order, limit).drop("rank")
