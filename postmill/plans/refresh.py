"""Silver kept up to date from new bronze batches, and rollups whose states merge."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.operators.silver import DERIVED, LATEST_BY, add_derived_columns, clean_text_fields, normalize_types
from postmill.plans.jobs import silver_order, transform_bronze_to_silver
from postmill.plans.latest import latest_rows
from postmill.sources.tables import BATCH, STORED, KeyedTable, append_batch, read_table, rows_at, staged, with_places


def _done(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema("name string").parquet(path).select("name")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "name string")


def _in_groups(groups: list, column: str = "subreddit") -> Column:
    named = F.col(column).isin([g for g in groups if g is not None])
    return named | F.col(column).isNull() if None in groups else named


def refresh_silver(spark: SparkSession, bronze_path: str, silver_path: str, state_path: str) -> dict[str, int]:
    """Bring silver up to date with the bronze batches it has not seen; the result is that of a full rebuild.

    ``state_path`` keeps what decides between copies (``LATEST_BY``) of the latest one of every post, stored by a hash of its id, and the
    names of the batches taken in. Copies of a post meet there by these narrow columns alone; only where they tie are whole rows compared,
    those known read from bronze. Whole rows are picked out of bronze by their places (``rows_at``) and shuffled once, by group.

    A group of silver that loses a row, as its post has a later copy, is read, changed and written over (dynamic partition overwrite). One that
    only gains rows gets files more, and is written over once it has many small ones. Others are neither read whole nor written. A
    group that loses its last post, whose folder no such write removes, has silver rebuilt, as has a silver that is not there yet.

    Silver is written before the state, and a batch is noted last: the next run after one that broke off finds what that has added to silver
    by its ids. A batch that replaces itself under its name must hold the same posts. Returns the numbers of batches, of posts that changed and of groups written.
    """
    bronze = with_places(read_table(spark, bronze_path)).withColumn(BATCH, F.col(BATCH).cast("string"))
    done = _done(spark, f"{state_path}/batches")
    # The names are partition values: no column of bronze is read for them.
    fresh = [r[0] for r in bronze.select(BATCH).distinct().join(done, F.col(BATCH) == F.col("name"), "left_anti").collect()]
    if not fresh:
        return {"batches": 0, "posts": 0, "groups": 0}
    latest = KeyedTable(spark, f"{state_path}/latest")
    if latest.exists():
        posts, groups = _take_in(spark, bronze, fresh, latest, bronze_path, silver_path)
    else:
        posts = transform_bronze_to_silver(spark, bronze_path, silver_path)
        silver = spark.read.schema(_silver_schema(spark, silver_path)).parquet(silver_path)
        groups = silver.select("subreddit").distinct().count()
        latest.upsert(silver.select("post_id", *LATEST_BY), "post_id")
    append_batch(spark.createDataFrame([(name,) for name in fresh], "name string").coalesce(1), f"{state_path}/batches")
    return {"batches": len(fresh), "posts": posts, "groups": groups}


def _take_in(spark: SparkSession, bronze: DataFrame, fresh: list[str], latest: KeyedTable, bronze_path: str, silver_path: str) -> tuple[int, int]:
    """Silver and state with the ``fresh`` batches; how many posts changed, and how many groups were written."""
    arrived = bronze.filter(F.col(BATCH).isin(fresh)).drop(BATCH)
    keys = staged(arrived.select("post_id").distinct(), "ids")
    known = latest.rows_of(keys, "post_id").select("post_id", *LATEST_BY)
    changed, narrow = latest_rows(arrived, known, bronze.filter(~F.col(BATCH).isin(fresh)).drop(BATCH))
    silver = with_places(spark.read.schema(_silver_schema(spark, silver_path)).parquet(silver_path).withColumn("_small", F.col("_metadata.file_size") < SMALL_FILE))
    ids = narrow.select(F.col("post_id").alias("_id"))
    held = silver.select("post_id", "subreddit", "_file", "_row").join(ids, F.col("post_id").eqNullSafe(F.col("_id")), "left_semi")
    gone = staged(held.drop("post_id"), "silver")
    # One name per group touched.
    lost = {r[0]: r[1] for r in gone.groupBy("subreddit").count().collect()}
    gained = [r[0] for r in narrow.select("subreddit").distinct().collect()]
    only_lost = [g for g in lost if g not in gained]
    if any(r[1] == lost[r[0]] for r in silver.filter(_in_groups(only_lost)).groupBy("subreddit").count().collect()):
        transform_bronze_to_silver(spark, bronze_path, silver_path)
    else:
        made = reduce(DataFrame.transform, (clean_text_fields, normalize_types), changed)
        over = [*lost, *_crowded(silver, [g for g in gained if g not in lost])]
        more = [g for g in gained if g not in over]
        if more:
            _write_groups(made.filter(_in_groups(more)).hint("rebalance", F.col("subreddit")), silver_path, "append")
        if over:
            # Rows of large files are written where they are read, those of small ones meet the new ones in few files.
            stays = rows_at(silver.filter(_in_groups(over)), gone, there=False).drop("_file", "_row", *DERIVED)
            moved = stays.filter("_small").drop("_small").unionByName(made.filter(_in_groups(over)), allowMissingColumns=True)
            rows = stays.filter("not _small").drop("_small").unionByName(moved.hint("rebalance", F.col("subreddit")), allowMissingColumns=True)
            _write_groups(rows, silver_path, "overwrite")
    latest.upsert(narrow.drop("subreddit"), "post_id")
    return narrow.count(), len({*lost, *gained})


# Files below this size are small, and a group with more of them than that is written over.
SMALL_FILE = 8 << 20
MOST_SMALL = 16


def _crowded(silver: DataFrame, groups: list) -> list:
    """Those of ``groups`` with too many small files; no column is read for it."""
    files = silver.filter(_in_groups(groups)).filter("_small").groupBy("subreddit").agg(F.count_distinct("_file").alias("files"))
    return [r[0] for r in files.filter(F.col("files") > MOST_SMALL).collect()]


def _write_groups(rows: DataFrame, silver_path: str, mode: str) -> None:
    """Rows without derived columns into their groups: these are derived behind the shuffle and the sort."""
    whole = add_derived_columns(rows.sortWithinPartitions("subreddit", *silver_order()))
    whole.write.mode(mode).options(**STORED).option("partitionOverwriteMode", "dynamic").partitionBy("subreddit").parquet(silver_path)


def _silver_schema(spark: SparkSession, path: str):
    """Silver's columns, with the group as text, whatever its names look like."""
    schema = spark.read.option("mergeSchema", "true").parquet(path).schema
    schema["subreddit"].dataType = spark.createDataFrame([], "s string").schema["s"].dataType
    return schema


# Gold as states. A state has the same keys as its rollup, and sums, counts and maxima that add up; what silver is split into does not matter.

_SUMS = ("score", "num_comments", "upvote_ratio", "title_length", "selftext_length")


def rollup_state(silver: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of rows and of non-null values, sums, sums of squares and maxima by ``keys``, as columns of a state."""
    measures = [F.count("post_id").alias("posts")]
    for c in _SUMS:
        measures += [F.count(c).alias(f"n_{c}"), F.sum(c).alias(f"sum_{c}")]
    # Squares as decimals are exact, so the order in which states merge leaves no trace.
    score = F.col("score").cast("decimal(19,0)")
    measures += [F.sum((score * score).cast("decimal(38,0)")).alias("squares_score")]
    measures += [F.max(c).alias(f"max_{c}") for c in ("score", "num_comments")]
    measures += [F.count_if("has_selftext").alias("with_text"), F.count_if(~F.col("has_selftext")).alias("without_text"), F.count_if("over_18").alias("nsfw")]
    return silver.groupBy(*keys).agg(*measures)


def author_state(silver: DataFrame) -> DataFrame:
    """The rollup by group and author, whose rows are also the exact set of a group's authors."""
    return rollup_state(silver.filter("author is not null"), ["subreddit", "author"])


def merged_state(states: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key out of the rows of several states."""
    values = [c for c in states.columns if c not in keys]
    return states.groupBy(*keys).agg(*((F.max if c.startswith("max_") else F.sum)(c).cast(states.schema[c].dataType).alias(c) for c in values))


def _mean(c: str) -> Column:
    return (F.col(f"sum_{c}").cast("double") / F.nullif(F.col(f"n_{c}"), F.lit(0))).alias(f"avg_{c}")


def daily_stats_of(state: DataFrame) -> DataFrame:
    """``build_subreddit_daily_stats`` from a state by subreddit and created_date."""
    return state.select(
        "subreddit", "created_date", F.col("posts").alias("post_count"), _mean("score"), _mean("num_comments").alias("avg_comments"),
        _mean("upvote_ratio"), F.col("sum_score").alias("total_score"), F.col("sum_num_comments").alias("total_comments"),
        _mean("title_length"), _mean("selftext_length"), F.col("with_text").alias("text_posts"), F.col("without_text").alias("link_posts"),
    )


def summary_of(state: DataFrame, authors: DataFrame) -> DataFrame:
    """``build_subreddit_summary`` from a state by subreddit and one of the authors."""
    n, total = F.col("n_score").cast("decimal(19,0)"), F.col("sum_score").cast("decimal(19,0)")
    # n * squares - total * total is exact up to where decimals end.
    spread = (n * F.col("squares_score") - total * total).cast("double")
    deviation = F.when(F.col("n_score") > 1, F.sqrt(spread / F.col("n_score") / (F.col("n_score") - 1)))
    distinct = authors.groupBy(F.col("subreddit").alias("_group")).agg(F.count("*").alias("unique_authors"))
    return state.join(distinct, F.col("subreddit").eqNullSafe(F.col("_group")), "left").select(
        "subreddit", F.col("posts").alias("total_posts"), _mean("score"), deviation.alias("stddev_score"), "max_score",
        _mean("num_comments").alias("avg_comments"), F.col("max_num_comments").alias("max_comments"), _mean("upvote_ratio"),
        F.coalesce("unique_authors", F.lit(0)).alias("unique_authors"), _mean("title_length"), F.col("nsfw").alias("nsfw_count"),
    )


def hourly_activity_of(state: DataFrame) -> DataFrame:
    """``build_hourly_activity`` from a state by subreddit, created_hour and day_of_week."""
    return state.select(
        "subreddit", "created_hour", "day_of_week", F.col("posts").alias("post_count"), _mean("score"), _mean("num_comments").alias("avg_comments")
    )


def author_activity_of(authors: DataFrame) -> DataFrame:
    """``build_author_activity`` from a state of the authors."""
    return authors.select(
        "subreddit", "author", F.col("posts").alias("post_count"), _mean("score"), F.col("sum_score").alias("total_score"),
        _mean("num_comments").alias("avg_comments"),
    )


STATE_KEYS = {
    "subreddit_daily_stats": ["subreddit", "created_date"],
    "subreddit_summary": ["subreddit"],
    "hourly_activity": ["subreddit", "created_hour", "day_of_week"],
    "author_activity": ["subreddit", "author"],
}


def state_input(silver: DataFrame) -> DataFrame:
    """The columns of silver that states are made of, written out: whatever makes silver runs once for all states."""
    needed = {"post_id", *_SUMS, "has_selftext", "over_18", *(key for keys in STATE_KEYS.values() for key in keys)}
    return staged(silver.select(*(c for c in silver.columns if c in needed)), "state_input")


def append_states(silver: DataFrame, state_path: str, batch: str) -> None:
    """Add the states of posts that are new since the last batch; a batch that comes again under its name replaces itself.

    Silver is read once for each state, so it should be a stored table, or ``state_input`` of one that is computed.
    """
    for name, keys in STATE_KEYS.items():
        state = author_state(silver) if name == "author_activity" else rollup_state(silver, keys)
        append_batch(state, f"{state_path}/{name}", batch=batch)


def gold_of_states(spark: SparkSession, state_path: str) -> dict[str, DataFrame]:
    """The four rollups over all batches whose states were added."""
    merged = {name: merged_state(read_table(spark, f"{state_path}/{name}").drop(BATCH), keys) for name, keys in STATE_KEYS.items()}
    return {
        "subreddit_daily_stats": daily_stats_of(merged["subreddit_daily_stats"]),
        "subreddit_summary": summary_of(merged["subreddit_summary"], merged["author_activity"]),
        "hourly_activity": hourly_activity_of(merged["hourly_activity"]),
        "author_activity": author_activity_of(merged["author_activity"]),
    }
