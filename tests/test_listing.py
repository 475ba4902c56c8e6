import json
from datetime import datetime

import pytest
from helpers import DAY, plan_of
from postmill.schema import PAGE_DDL, bronze_schema
from postmill.sources import listing

FULL = {
    "id": "a", "title": "t", "selftext": "s", "author": "ann", "score": 3, "upvote_ratio": 0.75, "num_comments": 4,
    "created_utc": 1704105000.0, "url": "u", "permalink": "/r/x/a", "is_self": True, "link_flair_text": "f",
    "over_18": False, "spoiler": True, "total_awards_received": 2,
}


def page(*posts, no=0, channel="g"):
    children = [{"kind": "t3", "data": p} for p in posts]
    return (channel, no, DAY, json.dumps({"data": {"children": children, "after": "next"}}))


def flat(spark, *pages):
    return listing.flatten_listing(spark.createDataFrame(list(pages), PAGE_DDL))


def one(spark, **changes):
    kept = {k: v for k, v in {**FULL, **changes}.items() if v != "absent"}
    return flat(spark, page(kept)).head()


def test_full_post(spark):
    row = flat(spark, page({**FULL, "subreddit": "other"}))
    assert row.columns == [*bronze_schema().fieldNames(), "page_no", "position"]
    assert {f.name: f.dataType for f in row.schema}["score"].simpleString() == "bigint"
    assert tuple(row.withColumn("created_utc", row.created_utc.cast("string")).drop("ingestion_timestamp").head()) == (
        "a", "g", "t", "s", "ann", 3, 0.75, 4, "2024-01-01 10:30:00", "u", "https://reddit.com/r/x/a", "True", "f",
        "False", "True", 2, 0, 0,
    )


def test_absent_keys_take_their_defaults(spark):
    row = flat(spark, page({"id": "a", "title": "t", "created_utc": 1})).head()
    assert (row.selftext, row.author, row.score, row.upvote_ratio, row.num_comments) == (None, "[deleted]", 0, 0.0, 0)
    assert (row.url, row.is_self, row.over_18, row.spoiler) == (None, "False", "False", "False")
    assert (row.link_flair_text, row.awards_received) == (None, 0)


def test_null_is_not_absent(spark):
    row = one(spark, author=None, is_self=None, selftext=None, score=None)
    assert (row.author, row.is_self, row.selftext, row.score) == (None, "None", None, 0)


@pytest.mark.parametrize("key, value, column", [("selftext", "", "selftext"), ("link_flair_text", None, "link_flair_text")])
def test_empty_values(spark, key, value, column):
    assert one(spark, **{key: value})[column] is None


def test_creation_time_keeps_microseconds(spark):
    created = flat(spark, page({**FULL, "created_utc": 1704067207.179575}))
    assert created.select(created.created_utc.cast("string")).head()[0] == "2024-01-01 00:00:07.179575"


def test_numbers_of_another_type(spark):
    row = one(spark, score="12", upvote_ratio="0.5", num_comments=7.0)
    assert (row.score, row.upvote_ratio, row.num_comments) == (12, 0.5, 7)


@pytest.mark.parametrize("key, value", [("score", "junk"), ("num_comments", 1e30), ("created_utc", 1e300), ("upvote_ratio", {})])
def test_numbers_that_cannot_be_read_are_rejected(spark, key, value):
    pages = spark.createDataFrame([page({**FULL, key: value}, FULL)], PAGE_DDL)
    assert listing.flatten_listing(pages).count() == 1
    assert [r.rejected for r in listing.rejects(pages).collect()] == [1]


def test_pages_that_cannot_be_read_are_counted(spark):
    good = page(FULL, {**FULL, "id": "b"})
    cut = (*page(FULL, no=1)[:3], good[3][: len(good[3]) // 2])
    pages = spark.createDataFrame([good, cut, ("g", 2, DAY, None), ("g", 3, DAY, "{}")], PAGE_DDL)
    assert listing.flatten_listing(pages).count() == 2
    assert sorted((r.reason, r.rejected) for r in listing.rejects(pages).collect()) == [("listing", 1), ("page", 2)]


def test_json_that_is_no_listing_is_counted_with_its_source(spark):
    shapes = ['{"error":429}', '{"data":{"children":"oops"}}', "[]", '{"data":{"children":null}}', "7", '{"data":{"children":[]}}']
    broken = {k: v for k, v in FULL.items() if k != "title"}
    rows = [("g", i, DAY, body) for i, body in enumerate(shapes)]
    pages = spark.createDataFrame([*rows, page(broken, FULL, {**FULL, "score": "x"}, no=8)], PAGE_DDL)
    landed = listing.landed_posts(pages)
    assert plan_of(landed).count("from_json") + plan_of(landed).count("jsontostructs") <= 2
    found = {(r.page_no, r.position): (r.reason, r.source) for r in listing.reject_rows(landed).collect()}
    assert {k: v for k, v in found.items() if k[1] is None} == {(i, None): ("listing", shapes[i]) for i in range(5)}
    assert [found[8, i][0] for i in (0, 2)] == ["incomplete", "number"] and json.loads(found[8, 2][1])["score"] == "x"
    assert listing.flatten_listing(pages).count() == 1


def test_large_whole_numbers_stay_exact(spark):
    row = one(spark, score="9007199254740993", num_comments=9223372036854775807, total_awards_received=9007199254740993)
    assert (row.score, row.num_comments, row.awards_received) == (9007199254740993, 9223372036854775807, 9007199254740993)


def test_pages_without_posts(spark):
    empty = [("g", i, DAY, body) for i, body in enumerate(['{"data":{"children":[]}}', '{"data":{}}', "{}", "junk", None])]
    assert flat(spark, *empty, page(FULL, no=9)).count() == 1


@pytest.mark.parametrize("key", ["id", "title", "created_utc"])
def test_incomplete_posts_are_set_aside(spark, key):
    broken = {k: v for k, v in FULL.items() if k != key}
    pages = spark.createDataFrame([page(broken, FULL)], PAGE_DDL)
    assert listing.flatten_listing(pages).count() == 1
    assert listing.rejected_posts(pages).count() == 1


def test_cap_takes_the_first_posts_in_page_order(spark):
    pages = [page(*({**FULL, "id": f"{c}{n}-{i}"} for i in range(3)), no=n, channel=c) for n in (10, 2, 1) for c in "gh"]
    capped = listing.cap_per_channel(flat(spark, *pages), 5)
    expected = {f"{c}{x}" for c in "gh" for x in ("1-0", "1-1", "1-2", "2-0", "2-1")}
    assert {r.post_id for r in capped.collect()} == expected


def test_cap_counts_each_fetch_on_its_own(spark):
    later = ("g", 0, datetime(2024, 2, 1), page(FULL, {**FULL, "id": "b"})[3])
    assert listing.cap_per_channel(flat(spark, page(FULL), later), 1).count() == 2
