import os
import time
from pathlib import Path

import pytest
from helpers import bronze_of, plan_of, post, rows_of
from postmill.__main__ import main
from postmill.checks import fixtures
from postmill.functions.vectors import hashing_encoder
from postmill.operators import gold
from postmill.operators.ranking import top_n_per_group
from postmill.operators.search import search_text
from postmill.operators.silver import silver_posts
from postmill.plans import jobs
from postmill.plans.late_top import rows_near_top
from postmill.sources import tables
from postmill.streaming.landing import ingest_landed_pages
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def test_all_steps(spark, path):
    lines = []
    rows = jobs.run_all(spark, fixtures.pages(spark, SMALL), path("root"), report=lines.append)
    assert rows["bronze"] == rows["silver"] == 1000
    assert rows["gold"]["top_posts"] == 250 and rows["gold"]["subreddit_summary"] == 5
    assert rows["vectors"] == 500
    assert [line.split(":")[0] for line in lines] == ["bronze", "silver", "gold", "vectors"]
    store = tables.KeyedTable(spark, path("root/vectors"))
    assert search_text(store.read(), "signup post", 3).count() == 3

    # A second run appends to bronze and leaves everything else as it was.
    again = jobs.run_all(spark, fixtures.pages(spark, SMALL), path("root"), report=lines.append)
    assert tables.read_table(spark, path("root/bronze")).count() == 2000
    assert again == rows


def test_a_failing_step_stops_the_run(spark, path):
    def broken():
        raise RuntimeError("no model")

    lines = []
    with pytest.raises(Exception, match="no model"):
        jobs.run_all(spark, fixtures.pages(spark, SMALL), path("root"), encoder=broken, report=lines.append)
    assert len(lines) == 3
    with pytest.raises(ValueError, match="no posts"):
        jobs.run_all(spark, fixtures.pages(spark, SMALL).limit(0), path("empty"), report=lines.append)
    assert len(lines) == 3


def stored_silver(spark, path, posts):
    tables.overwrite_table(silver_posts(bronze_of(spark, *posts)), path("silver"), "subreddit")
    return spark.read.parquet(path("silver"))


def hot_posts():
    hot = [post(f"h{i}", subreddit="hot", score=i % 50) for i in range(400)]
    few = [post(f"f{i}", subreddit="few", score=None if i < 2 else i) for i in range(4)]
    unknown = [post(f"u{i}", subreddit=None, score=i) for i in range(30)]
    return hot + few + unknown


def test_late_top_equals_plain_top(spark, path):
    silver = stored_silver(spark, path, hot_posts())
    near = rows_near_top(silver, "subreddit", "score", 10)
    columns = ("subreddit", "rank", "post_id")
    found = {tuple(r) for r in gold.build_top_posts(near, 10).select(*columns).collect()}
    plain = {tuple(r) for r in gold.build_top_posts(silver, 10).select(*columns).collect()}
    assert found == plain and len(found) == 24
    assert near.count() == 16 + 4 + 10


def test_late_top_of_many_groups_is_one_plan(spark, path):
    rows = spark.range(20_000).selectExpr("id", "concat('g', id % 5000) as g", "id * 7919 % 1009 as score", "'wide' as body")
    rows.write.parquet(path("many"))
    stored = spark.read.parquet(path("many"))
    near = rows_near_top(stored, "g", "score", 2)
    assert plan_of(near).count("Scan parquet") < 6
    best = top_n_per_group(near, ["g"], [F.desc("score"), F.asc("id")], 2)
    plain = top_n_per_group(stored, ["g"], [F.desc("score"), F.asc("id")], 2)
    assert best.count() == 10_000 and best.exceptAll(plain).isEmpty()


def test_late_top_pushes_the_lowest_cutoff_down(spark, path):
    silver = stored_silver(spark, path, [post(f"p{i}", score=i) for i in range(400)])
    plan = plan_of(rows_near_top(silver, "subreddit", "score", 10))
    assert "BroadcastHashJoin" in plan and "GreaterThanOrEqual(score,ScalarSubquery" in plan


def test_late_top_of_an_empty_table(spark, path):
    silver = silver_posts(bronze_of(spark))
    assert rows_near_top(silver, "subreddit", "score", 10).count() == 0


def test_vectors_of_posts_that_left_the_top_stay_unless_replaced(spark, path):
    stored_silver(spark, path, [post("a", score=1), post("b", score=2)])
    build = lambda **more: jobs.build_vector_store(spark, path("silver"), path("v"), top_n=1, **more)
    assert build() == 1
    stored_silver(spark, path, [post("a", score=3), post("b", score=2)])
    assert build(encoder=hashing_encoder(64)) == 2
    assert build(replace=True) == 1
    assert rows_of(tables.KeyedTable(spark, path("v")).read(), "post_id") == [("a",)]


def test_only_unseen_texts_are_encoded(spark, path):
    seen = Path(path("seen"))
    seen.mkdir()

    def counting():
        load = hashing_encoder(8)()

        def encode(texts):
            (seen / f"{os.getpid()}-{time.monotonic_ns()}").write_text("\n".join(texts))
            return load(texts)

        return encode

    def build(**more):
        before = set(seen.iterdir())
        rows = jobs.build_vector_store(spark, path("silver"), path("v"), encoder=counting, **more)
        return rows, sorted(t for f in set(seen.iterdir()) - before for t in f.read_text().split("\n"))

    stored_silver(spark, path, [post(x, title=x, selftext=None, score=1) for x in "abc"])
    assert build() == (3, ["a", "b", "c"])
    files = {f: f.stat().st_mtime_ns for f in Path(path("v")).rglob("*.parquet")}
    assert build() == (3, [])
    assert files == {f: f.stat().st_mtime_ns for f in Path(path("v")).rglob("*.parquet")}
    # A changed text, a new post, and a post that moved to another group with its text as it was.
    stored_silver(spark, path, [post("a", title="a", selftext="more"), post("b", title="b", selftext=None, subreddit="h"), post("d", title="d", selftext=None)])
    assert build() == (4, ["a more", "d"])
    found = {r["post_id"]: (r["subreddit"], r["document"]) for r in tables.KeyedTable(spark, path("v")).read().collect()}
    assert found == {"a": ("g", "a more"), "b": ("h", "b"), "c": ("g", "c"), "d": ("g", "d")}
    assert build(encoder_name="another")[1] == ["a more", "b", "d"]


def test_silver_with_stated_bronze_schema(spark, path):
    bronze = bronze_of(spark, post("a"), post("a", score=9))
    tables.append_bronze(bronze, path("bronze"))
    assert jobs.transform_bronze_to_silver(spark, path("bronze"), path("silver"), schema=bronze.schema) == 1


def test_landed_pages_are_ingested_once(spark, path):
    pages = fixtures.pages(spark, SMALL).persist()
    run = lambda: ingest_landed_pages(spark, path("pages"), path("bronze"), path("progress"))
    count = lambda: tables.read_table(spark, path("bronze")).count()
    tables.write_json_lines(pages.filter("page_no < 4"), path("pages"))
    run()
    assert count() == 400
    run()
    assert count() == 400
    pages.filter("page_no >= 4").write.mode("append").options(**tables.JSON_TIMES).json(path("pages"))
    run()
    assert count() == 1000
    bronze = tables.read_table(spark, path("bronze"))
    assert bronze.select("post_id").distinct().count() == 1000
    assert silver_posts(bronze).count() == 1000


def test_command_line(spark, path, capsys):
    tables.write_json_lines(fixtures.pages(spark, SMALL), path("pages"))
    main(["run", path("pages"), path("root")])
    assert "vectors: 500 rows" in capsys.readouterr().out
    main(["search", path("root"), "signup post", "--results", "2", "--group", "signup"])
    out = capsys.readouterr().out
    assert out.count("https://reddit.com/comments/p") == 2 and "|signup" in out and "|view" not in out


def test_vectors_stored_by_bucket(spark, path, capsys):
    tables.write_json_lines(fixtures.pages(spark, SMALL), path("pages"))
    for _ in range(2):
        main(["--bits", "3", "run", path("pages"), path("root")])
        assert "vectors: 500 rows" in capsys.readouterr().out
    records = tables.KeyedTable(spark, path("root/vectors")).read()
    assert records.select("post_id").distinct().count() == 500
    exact = rows_of(search_text(records, "signup post", 4), "post_id", "similarity")
    assert rows_of(search_text(records, "signup post", 4, bits=3, radius=3), "post_id", "similarity") == exact
    near = search_text(records, "signup post", 4, bits=3, radius=0)
    # Both the ranking and the look-up of texts read the near folders only.
    assert near.count() and plan_of(near).count("PartitionFilters: [isnotnull(bucket") == 2
    stored = search_text(tables.KeyedTable(spark, path("root/vectors")), "signup post", 4)
    assert rows_of(stored, "post_id", "similarity") == exact and plan_of(stored).count("Scan parquet") == 1
    main(["--bits", "3", "search", path("root"), "signup post", "--results", "2", "--radius", "3"])
    assert capsys.readouterr().out.count("https://reddit.com/comments/p") == 2


def test_job_and_stream_share_one_bronze(spark, path):
    landed = fixtures.pages(spark, SMALL)
    jobs.ingest_pages(landed, path("bronze"))
    tables.write_json_lines(landed, path("pages"))
    for _ in range(2):
        ingest_landed_pages(spark, path("pages"), path("bronze"), path("progress"))
    found = tables.read_bronze(spark, path("bronze"))
    assert found.count() == 2000 and len(found.columns) == 17
    with pytest.raises(ValueError, match="no posts"):
        jobs.ingest_pages(landed.limit(0), path("none"))
    assert not Path(path("none")).exists()


def test_rejects_are_stored_by_job_and_stream(spark, path):
    good = fixtures.pages(spark, SMALL).filter("page_no < 2")
    odd = good.limit(2).withColumn("body", F.lit('{"error":429}'))
    tables.write_json_lines(good.unionByName(odd), path("pages"))
    counts = jobs.ingest_landed(good.unionByName(odd), path("bronze"), path("rejects"))
    assert counts == {"posts": 200, "rejected": 2}
    for _ in range(2):
        ingest_landed_pages(spark, path("pages"), path("bronze"), path("progress"), path("rejects"))
    stored = tables.read_bronze(spark, path("rejects"))
    assert rows_of(stored.select("reason", "source")) == [("listing", '{"error":429}')] * 4
    with pytest.raises(ValueError, match="no posts"):
        jobs.ingest_pages(odd, path("none"), rejects_path=path("all"))
    assert tables.read_bronze(spark, path("all")).count() == 2 and not Path(path("none")).exists()


def test_merged_columns_reach_silver(spark, path):
    noted = bronze_of(spark, post("x")).withColumn("note", F.lit("kept"))
    tables.append_bronze(noted, path("root/bronze"))
    rows = jobs.run_all(spark, fixtures.pages(spark, SMALL).filter("page_no < 2"), path("root"), report=lambda _: None)
    assert rows["rejected"] == 0
    silver = tables.read_table(spark, path("root/silver"))
    assert rows_of(silver.filter("note is not null"), "post_id", "note") == [("x", "kept")] and silver.count() == 201


def test_group_names_stay_text(spark, path):
    posts = [post("a", subreddit="007"), post("b", subreddit="08")]
    tables.append_bronze(bronze_of(spark, *posts), path("bronze"))
    jobs.transform_bronze_to_silver(spark, path("bronze"), path("silver"))
    jobs.transform_silver_to_gold(spark, path("silver"), path("gold"))
    assert rows_of(tables.read_table(spark, path("gold/subreddit_summary")), "subreddit") == [("007",), ("08",)]
    jobs.build_vector_store(spark, path("silver"), path("vectors"))
    assert rows_of(tables.KeyedTable(spark, path("vectors")).read(), "subreddit") == [("007",), ("08",)]
