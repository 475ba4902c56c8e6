"""The latest copies of posts out of stored bronze, without moving whole rows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postmill.operators.silver import LATEST_BY, deduplicate_posts
from postmill.sources.tables import rows_at, staged


def latest_rows(bronze: DataFrame, known: DataFrame | None = None, before: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of ``deduplicate_posts`` out of a table ``with_places``, and their ``post_id``, ``subreddit`` and ``LATEST_BY``.

    Copies of a post meet by ``LATEST_BY`` alone, and whole rows are picked out of the files by their places; only where the first copies tie
    are whole rows ranked. With ``known``, which holds ``post_id`` and ``LATEST_BY`` of earlier copies, posts whose latest copy is one of those are
    left out, as are new copies equal to it; ``before`` is the table that holds these copies as whole rows.
    """
    top = staged(_first_copies(bronze, known), "top")
    single, tied = top.filter("_copies = 1"), top.filter("_copies > 1")
    rows = rows_at(bronze, single).drop("_file", "_row")
    narrow = single.select("post_id", "subreddit", *LATEST_BY)
    if not tied.isEmpty():
        settled = staged(_settled(rows_at(bronze, tied), tied, before), "changed")
        rows, narrow = rows.unionByName(settled), narrow.unionByName(settled.select(*narrow.columns))
    return rows, narrow


def _first_copies(bronze: DataFrame, known: DataFrame | None) -> DataFrame:
    """The copies that come first by ``LATEST_BY``, with their places; how many copies of a post do, and how many of these are known."""
    copies = bronze.select("post_id", "subreddit", *LATEST_BY, "_file", "_row")
    if known is not None:
        copies = copies.unionByName(known.select("post_id", *LATEST_BY), allowMissingColumns=True)
    post = Window.partitionBy("post_id")
    first = copies.withColumn("_rank", F.rank().over(post.orderBy(*(F.desc(c) for c in LATEST_BY)))).filter("_rank = 1").drop("_rank")
    counts = {"_copies": F.count("*").over(post), "_known": F.count_if(F.col("_file").isNull()).over(post)}
    return first.withColumns(counts).filter("_file is not null")


def _settled(rivals: DataFrame, tied: DataFrame, before: DataFrame | None) -> DataFrame:
    """Of the posts whose first copies tie, the latest ones as whole rows, unless a known copy is it."""
    if before is None:
        return deduplicate_posts(rivals.drop("_file", "_row"))
    ids = tied.filter("_known > 0").select(F.col("post_id").alias("_id")).distinct()
    old = before.join(ids, F.col("post_id").eqNullSafe(F.col("_id")), "left_semi")
    # Of equal copies the known one wins, and nothing changes.
    new, old = (df.drop("_file", "_row").withColumn("_new", F.lit(flag)) for df, flag in ((rivals, True), (old, False)))
    return deduplicate_posts(new.unionByName(old)).filter("_new").drop("_new")
