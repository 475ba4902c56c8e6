from datetime import timedelta

import pytest
from helpers import DAY, bronze_of, plan_of, post, rows_of
from postmill.checks import fixtures
from postmill.operators import gold
from postmill.operators.ranking import top_n_per_group
from postmill.operators.silver import silver_posts
from pyspark.sql import functions as F


def silver_of(spark, *posts):
    return silver_posts(bronze_of(spark, *posts))


@pytest.fixture(scope="module")
def silver(spark):
    return silver_posts(fixtures.bronze(spark, "/root/testdata/sf0.001")).persist()


def test_counts_agree_between_tables(silver):
    summary = rows_of(gold.build_subreddit_summary(silver), "subreddit", "total_posts")
    for table in (gold.build_subreddit_daily_stats(silver), gold.build_hourly_activity(silver)):
        assert rows_of(table.groupBy("subreddit").agg(F.sum("post_count"))) == summary
    authored = gold.build_author_activity(silver).agg(F.sum("post_count")).head()[0]
    assert authored + silver.filter("author is null").count() == silver.count()


def test_text_and_link_posts_make_all_posts(silver):
    daily = gold.build_subreddit_daily_stats(silver)
    assert daily.filter("text_posts + link_posts <> post_count").count() == 0
    assert daily.agg(F.sum("text_posts")).head()[0] == 144


def test_ranks_count_from_one(silver):
    ranks = gold.build_top_posts(silver, 7).groupBy("subreddit").agg(F.sort_array(F.collect_list("rank")))
    assert {tuple(r[1]) for r in ranks.collect()} == {tuple(range(1, 8))}


def test_summary_of_one_post(spark):
    row = gold.build_subreddit_summary(silver_of(spark, post(over_18=None, author="[deleted]"))).head()
    assert row.stddev_score is None
    assert (row.total_posts, row.nsfw_count, row.unique_authors) == (1, 0, 0)


def test_summary_measures(spark):
    posts = [post(f"p{i}", score=s, author=a, over_18="True") for i, (s, a) in enumerate([(1, "x"), (3, "x"), (8, "y")])]
    row = gold.build_subreddit_summary(silver_of(spark, *posts)).head()
    assert (row.avg_score, row.max_score, row.unique_authors, row.nsfw_count) == (4.0, 8, 2, 3)
    assert row.stddev_score == pytest.approx(13**0.5)


def test_daily_and_hourly_split_by_utc_time(spark):
    rows = silver_of(spark, post("a"), post("b", created_utc=DAY + timedelta(hours=14)))
    assert gold.build_subreddit_daily_stats(rows).count() == 2
    assert rows_of(gold.build_hourly_activity(rows), "created_hour", "day_of_week") == [(0, 3), (10, 2)]


def test_null_scores_rank_last_and_ties_by_id(spark):
    rows = silver_of(spark, post("c", score=None), post("b", score=5), post("a", score=5), post("d", score=0))
    ranked = gold.build_top_posts(rows)
    assert [r.post_id for r in ranked.orderBy("rank").collect()] == ["a", "b", "d", "c"]
    assert rows_of(gold.build_top_posts(rows, 2), "post_id") == [("a",), ("b",)]


def test_candidates_have_four_columns(silver):
    candidates = gold.embedding_candidates(silver, 3)
    assert candidates.columns == ["post_id", "subreddit", "title", "content"]
    assert candidates.count() == 15


def test_hot_group_ranks_like_a_plain_sort(spark):
    rows = spark.range(0, 30_000, numPartitions=32).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        (F.col("id") * 7919 % 1009).alias("score"),
        "id",
    )
    found = top_n_per_group(rows, ["g"], [F.desc("score"), F.asc("id")], 25, fan_in=4)
    plain = rows.toPandas().sort_values(["g", "score", "id"], ascending=[True, False, True])
    expected = plain.groupby("g").head(25)
    assert rows_of(found, "g", "score", "id") == sorted(expected.itertuples(index=False, name=None))


def test_group_limit_holds_for_large_n(spark):
    rows = spark.range(0, 9_000, numPartitions=4).selectExpr("id % 2 as g", "id as score")
    found = top_n_per_group(rows, ["g"], [F.desc("score")], 2000, fan_in=2)
    assert plan_of(found).count("WindowGroupLimit") >= 2
    assert rows_of(found.groupBy("g").agg(F.count("*"), F.min("score"))) == [(0, 2000, 5000), (1, 2000, 5001)]


def test_reports_are_sorted_and_limited(spark):
    posts = [post(f"{g}{i}", subreddit=f"g{g:02d}") for g in range(25) for i in range(g % 3 + 1)]
    bronze = bronze_of(spark, *posts)
    profile = gold.bronze_profile(bronze).collect()
    assert len(profile) == 20
    assert [(-r["count"], r.subreddit) for r in profile] == sorted((-r["count"], r.subreddit) for r in profile)
    assert [r.posts for r in gold.silver_profile(silver_posts(bronze), 2).collect()] == [3, 3]
    summary = gold.build_subreddit_summary(silver_posts(bronze))
    assert gold.summary_report(summary, 3).head().subreddit == "g02"


def test_empty_silver(spark):
    empty = silver_of(spark)
    for build in gold.ROLLUPS.values():
        assert build(empty).count() == 0
    assert gold.build_top_posts(empty).count() == 0
