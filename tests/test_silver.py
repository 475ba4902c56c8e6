from datetime import date, timedelta
from random import Random

import pytest
from helpers import DAY, bronze_of, plan_of, post, rows_of
from postmill.operators import silver

CONTROLS = "".join(map(chr, [*range(0x20), 0x7F]))


def cleaned(spark, **changes):
    return silver.clean_text_fields(bronze_of(spark, post(**changes))).head()


@pytest.mark.parametrize(
    "raw, clean",
    [
        (f"a{CONTROLS}b", "ab"),
        (" a\nb\t ", "ab"),
        (" a ", " a "),
        ("\t \t", ""),
        ("a\u0080b", "a\u0080b"),
        (None, None),
    ],
)
def test_control_characters_are_deleted_and_spaces_trimmed(spark, raw, clean):
    assert cleaned(spark, title=raw).title == clean


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("", None),
        (" \n ", None),
        ("[removed]", None),
        (" [del\neted] ", None),
        ("[Removed]", "[Removed]"),
        ("[removed] x", "[removed] x"),
        (None, None),
    ],
)
def test_body_placeholders_are_found_after_cleaning(spark, raw, clean):
    assert cleaned(spark, selftext=raw).selftext == clean


@pytest.mark.parametrize("raw, clean", [("[deleted]", None), (" [deleted] ", " [deleted] "), ("a\tb", "a\tb"), (None, None)])
def test_author_is_compared_as_it_is(spark, raw, clean):
    assert cleaned(spark, author=raw).author == clean


@pytest.mark.parametrize("raw, clean", [(None, "unflaired"), ("", ""), (" ÄB ", "äb"), ("\tA ", "\ta")])
def test_flair(spark, raw, clean):
    assert cleaned(spark, link_flair_text=raw).link_flair_text == clean


@pytest.mark.parametrize("raw, flag", [("True", True), ("False", False), ("None", None), ("junk", None), (None, None)])
def test_flags(spark, raw, flag):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    row = silver.normalize_types(bronze_of(spark, post(is_self=raw, over_18=raw, spoiler=raw))).head()
    assert (row.is_self, row.over_18, row.spoiler) == (flag, flag, flag)


@pytest.mark.parametrize(
    "title, body, lengths, content",
    [
        ("a\U0001f600", "xyz", (2, 3), "a\U0001f600 xyz"),
        ("a", None, (1, 0), "a"),
        (None, "b", (None, 1), "b"),
        (None, None, (None, 0), None),
        ("", "b", (0, 1), " b"),
    ],
)
def test_derived_text_columns(spark, title, body, lengths, content):
    row = silver.add_derived_columns(bronze_of(spark, post(title=title, selftext=body))).head()
    assert (row.title_length, row.selftext_length) == lengths
    assert row.content == content
    assert row.has_selftext is (body is not None)


def test_random_texts_clean_like_plain_python(spark):
    random = Random(7)
    alphabet = CONTROLS + "   \u00a0[]ab\U0001f600é\u2028"
    words = ["[removed]", "[deleted]", ""]
    texts = [random.choice(words) + "".join(random.choices(alphabet, k=random.randrange(9))) for _ in range(2000)]
    rows = [post(f"p{i}", title=t, selftext=t) for i, t in enumerate(texts)]
    found = silver.silver_posts(bronze_of(spark, *rows))
    expected = []
    for i, t in enumerate(texts):
        clean = "".join(c for c in t if c not in CONTROLS).strip(" ")
        body = None if clean in words else clean
        content = clean if body is None else f"{clean} {body}"
        expected.append((f"p{i}", clean, body or "", len(clean), len(body or ""), body is not None, content))
    columns = found.fillna("", ["selftext"])
    names = ("post_id", "title", "selftext", "title_length", "selftext_length", "has_selftext", "content")
    assert rows_of(columns, *names) == sorted(expected)


def test_derived_times(spark):
    row = silver.add_derived_columns(bronze_of(spark, post())).head()
    assert (row.created_date, row.created_hour, row.day_of_week) == (date(2024, 1, 1), 10, 2)


def test_latest_copy_is_kept(spark):
    copies = [post("a", score=s, ingestion_timestamp=DAY + timedelta(days=d)) for s, d in ((9, 0), (1, 2), (5, 1))]
    kept = silver.deduplicate_posts(bronze_of(spark, *copies, post("b", score=7)))
    assert rows_of(kept, "post_id", "score") == [("a", 1), ("b", 7)]


def test_ties_of_one_fetch_are_settled_the_same_way_in_any_order(spark):
    copies = [post("a", score=s, num_comments=c, title=t) for s, c, t in ((1, 9, "x"), (2, 1, "y"), (2, 3, "z"), (2, 3, "b"))]
    for order in (copies, copies[::-1]):
        assert rows_of(silver.deduplicate_posts(bronze_of(spark, *order)), "title") == [("b",)]


def test_hot_post_leaves_each_task_once(spark):
    hot = [post("hot", score=i) for i in range(3000)]
    rest = [post(f"p{i}", score=i) for i in range(3000)]
    rows = bronze_of(spark, *hot, *rest).repartition(16)
    kept = silver.deduplicate_posts(rows)
    assert rows_of(kept.filter("post_id = 'hot'"), "score") == [(2999,)]
    assert kept.count() == 3001
    before_shuffle = plan_of(kept).split("Exchange")[1]
    assert "Partial" in before_shuffle and "WindowGroupLimit" in before_shuffle


def test_deduplication_twice_changes_nothing(spark):
    rows = bronze_of(spark, *(post(f"p{i % 7}", score=i) for i in range(40)))
    once = silver.deduplicate_posts(rows)
    assert rows_of(silver.deduplicate_posts(once)) == rows_of(once)


def test_duplicates_removed(spark):
    rows = [post("a"), post("a"), post("b")]
    assert silver.duplicates_removed(bronze_of(spark, *rows)).head().removed == 1
    assert silver.duplicates_removed(bronze_of(spark)).head().removed == 0


def test_empty_table(spark):
    result = silver.silver_posts(bronze_of(spark))
    assert result.count() == 0
    assert len(result.columns) == 24


def test_cleaning_runs_once_per_text(spark):
    plan = plan_of(silver.silver_posts(bronze_of(spark, post())))
    assert plan.count("regexp_replace(selftext") == 1


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    copies = [post("a", selftext=f"v{i}") for i in range(6)]
    found = [silver.deduplicate_posts(bronze_of(spark, *rows)).head().selftext for rows in (copies, copies[::-1])]
    assert found == ["v0", "v0"]


def test_no_derived_text_is_shuffled(spark):
    plan = plan_of(silver.silver_posts(bronze_of(spark, post()), rebalance_by="subreddit"))
    # The plan is printed from its end: the rebalance comes after the last projection of content.
    spread = plan.index("Exchange hashpartitioning(subreddit")
    assert "AS content" in plan[:spread] and "AS content" not in plan[spread:]


def test_ties_do_not_hang_on_the_order_of_rows(spark):
    copies = [post(selftext=f"v{i}") for i in range(6)]
    for rows in (copies, copies[::-1]):
        assert silver.deduplicate_posts(bronze_of(spark, *rows).repartition(3)).head().selftext == "v0"
