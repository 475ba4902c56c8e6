import json
from datetime import timedelta
from pathlib import Path
from types import SimpleNamespace

import pytest
from helpers import DAY, bronze_of, plan_of, post, records_shuffled, rows_of, rows_scanned
from postmill import session
from postmill.operators.silver import silver_posts
from postmill.plans import jobs
from postmill.sources import tables
from pyspark.sql import functions as F


def test_json_lines_keep_microseconds(spark, path):
    odd = DAY + timedelta(microseconds=123456)
    rows = bronze_of(spark, post("a", created_utc=odd, selftext="line\nbreak   \U0001f600"), post("b", score=None))
    tables.write_json_lines(rows, path("lines"))
    back = tables.read_json_lines(spark, path("lines"))
    assert back.schema.simpleString() == rows.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


@pytest.mark.parametrize(
    "written, read",
    [
        ("2024-01-01T10:30:00+00:00", "2024-01-01 10:30:00"),
        ("2024-01-01T10:30:00.123456+00:00", "2024-01-01 10:30:00.123456"),
        ("2024-01-01T12:30:00.5+02:00", "2024-01-01 10:30:00.5"),
        ("2024-01-01T10:30:00Z", "2024-01-01 10:30:00"),
        ("junk", None),
    ],
)
def test_iso_times_are_read(spark, path, written, read):
    Path(path("lines")).write_text(json.dumps({"post_id": "a", "created_utc": written, "score": 5}))
    row = tables.read_json_lines(spark, path("lines")).select(F.col("created_utc").cast("string"), "score", "url").head()
    assert tuple(row) == (read, 5, None)


def test_records_are_ingested(spark, path):
    assert jobs.ingest_to_bronze(spark, (post(i) for i in "ab"), path("t")) == 2
    assert jobs.ingest_to_bronze(spark, [post("c")], path("t")) == 1
    assert rows_of(tables.read_table(spark, path("t")), "post_id") == [("a",), ("b",), ("c",)]


def test_append_merges_new_columns(spark, path):
    assert tables.append_bronze(bronze_of(spark, post("a")), path("t")) == 1
    assert tables.append_bronze(bronze_of(spark, post("b")).withColumn("extra", F.lit(5)), path("t")) == 1
    assert rows_of(tables.read_table(spark, path("t")).filter("extra is null"), "post_id") == [("a",)]
    stated = "post_id string, extra int"
    assert tables.read_table(spark, path("t"), stated).filter("extra = 5").head().post_id == "b"


def test_append_refuses_other_types(spark, path):
    rows = bronze_of(spark, post())
    with pytest.raises(ValueError, match="score"):
        tables.append_bronze(rows.withColumn("score", F.col("score").cast("int")), path("t"))
    with pytest.raises(ValueError, match="url"):
        tables.append_bronze(rows.drop("url"), path("t"))
    assert not Path(path("t")).exists()


def test_append_puts_columns_in_order(spark, path):
    rows = bronze_of(spark, post())
    tables.append_bronze(rows.select(*reversed(rows.columns)), path("t"))
    assert tables.read_bronze(spark, path("t")).columns == rows.columns


def test_a_batch_written_again_replaces_itself(spark, path):
    tables.append_bronze(bronze_of(spark, post("a")), path("t"))
    for _ in range(2):
        tables.append_bronze(bronze_of(spark, post("b")), path("t"), batch="x")
    assert rows_of(tables.read_bronze(spark, path("t")), "post_id") == [("a",), ("b",)]


def test_overwrite_replaces_rows_and_columns(spark, path):
    assert tables.overwrite_table(spark.range(5), path("t")) == 5
    assert tables.overwrite_table(spark.range(3).withColumnRenamed("id", "n"), path("t")) == 3
    assert tables.read_table(spark, path("t")).columns == ["n"]


def test_partitioned_table_is_pruned_and_few_files_are_written(spark, path):
    silver = silver_posts(bronze_of(spark, *(post(f"p{i}", subreddit=f"g{i % 3}") for i in range(600))).repartition(20))
    assert tables.overwrite_table(silver, path("t"), "subreddit") == 600
    back = tables.read_table(spark, path("t"), silver.schema).select(*silver.columns)
    one = back.filter("subreddit = 'g1'").select("post_id")
    assert "PartitionFilters: [isnotnull(subreddit" in plan_of(one)
    assert "ReadSchema: struct<post_id:string>" in plan_of(one)
    assert one.count() == 200
    assert rows_of(back, "post_id", "content") == rows_of(silver, "post_id", "content")
    assert len(list(Path(path("t")).rglob("*.parquet"))) == 3


@pytest.mark.parametrize("rebalance, adaptive", [(False, "true"), (True, "false")])
def test_partitioned_write_without_rebalancing(spark, path, rebalance, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        rows = spark.range(0, 100, 1, 4).select("id", (F.col("id") % 2).alias("g"))
        assert tables.overwrite_table(rows, path("t"), "g", rebalance) == 100
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(list(Path(path("t")).rglob("*.parquet"))) == 8
    assert tables.read_table(spark, path("t")).count() == 100


def keyed(spark, path):
    return tables.KeyedTable(spark, path("v"), parts=8)


def vectors(spark, **records):
    return spark.createDataFrame([(k, [float(v)]) for k, v in records.items()], "post_id string, embedding array<float>")


def files_of(path):
    return {f: f.stat().st_mtime_ns for f in Path(path("v")).rglob("*.parquet")}


def test_upsert_replaces_adds_and_keeps(spark, path):
    store = keyed(spark, path)
    assert not store.exists() and store.count() == 0
    assert store.upsert(vectors(spark, a=1, b=2), "post_id") == 2
    assert store.upsert(vectors(spark, b=3, c=4), "post_id") == 3
    assert rows_of(store.read()) == [("a", [1.0]), ("b", [3.0]), ("c", [4.0])]
    store.upsert(vectors(spark, b=3, c=4), "post_id")
    assert store.count() == 3


def test_upsert_leaves_other_folders_as_they_are(spark, path):
    store = keyed(spark, path)
    store.upsert(vectors(spark, **{f"k{i}": i for i in range(60)}), "post_id")
    before = files_of(path)
    assert len({f.parent for f in before}) == 8
    # Another number of parts does not change the layout of a table that is there.
    assert tables.KeyedTable(spark, path("v"), parts=3).upsert(vectors(spark, k5=100), "post_id") == 60
    after = files_of(path)
    assert len({f.parent for f in set(before) - set(after)}) == len({f.parent for f in set(after) - set(before)}) == 1
    assert all(after[f] == t for f, t in before.items() if f in after)
    assert ("k5", [100.0]) in rows_of(store.read())
    plan = plan_of(store.read().filter("post_id = 'k7'"))
    assert "EqualTo(post_id,k7)" in plan
    store.upsert(vectors(spark, a=1).limit(0), "post_id")
    assert files_of(path) == after


def test_rows_that_move_to_another_folder_leave_none_behind(spark, path):
    store = keyed(spark, path)
    rows = lambda *r: spark.createDataFrame(r, "post_id string, bucket int")
    store.upsert(rows(("a", 1), ("b", 1), ("c", 2)), "post_id", "bucket")
    for bucket in (2, 3, 1):
        assert store.upsert(rows(("a", bucket)), "post_id", "bucket") == 3
        assert rows_of(store.read(), "post_id", "bucket") == [("a", bucket), ("b", 1), ("c", 2)]


def test_replace_forgets_old_rows(spark, path):
    store = keyed(spark, path)
    store.upsert(vectors(spark, a=1), "post_id")
    store.replace(vectors(spark, b=1), "post_id")
    assert rows_of(store.read(), "post_id") == [("b",)]
    # Also with rows of its own, and with further columns.
    assert store.replace(store.read(), "post_id") == 1
    assert store.upsert(vectors(spark, c=2).withColumn("note", F.lit("n")), "post_id") == 2
    assert rows_of(store.read(), "post_id", "note") == [("b", None), ("c", "n")]


def test_upsert_settles_copies_within_a_batch(spark, path):
    store = keyed(spark, path)
    store.upsert(vectors(spark, a=1, b=2), "post_id")
    batch = spark.createDataFrame([("b", [9.0]), ("b", [3.0]), (None, [4.0])], "post_id string, embedding array<float>")
    for _ in range(2):
        assert store.upsert(batch, "post_id") == 3
    assert sorted((r[0] or "-", r[1]) for r in store.read().collect()) == [("-", [4.0]), ("a", [1.0]), ("b", [3.0])]


def test_reading_nothing(spark, path):
    with pytest.raises(ValueError, match="no rows are stored"):
        keyed(spark, path).read()


def session_with(master, shared=None, checkpoints=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoints)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: shared), sparkContext=context)


def test_scratch_is_below_the_shared_folder():
    cluster = session_with("spark://host:7077", "s3a://bucket/shared/", "/other")
    one, two = (session.scratch_path(cluster, "x") for _ in range(2))
    assert one.startswith("s3a://bucket/shared/postmill/") and one.endswith("/x") and one != two
    assert session.scratch_path(session_with("yarn", None, "hdfs:/c"), "x").startswith("hdfs:/c/postmill/")


def test_scratch_is_in_the_warehouse_where_no_folder_is_set():
    values = {"spark.sql.warehouse.dir": "hdfs:/w"}
    conf = SimpleNamespace(get=lambda key, default=None: values.get(key, default), set=values.__setitem__)
    bare = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getCheckpointDir=lambda: None))
    assert session.scratch_path(bare, "x").startswith("hdfs:/w/checkpoints/postmill/")
    assert values["spark.checkpoint.dir"] == "hdfs:/w/checkpoints"


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_lookup_reads_the_folders_and_row_groups_of_its_keys(spark, path):
    store = tables.KeyedTable(spark, path("v"), parts=8)
    rows = spark.range(40_000).selectExpr("concat('p', id) as post_id", "id as n", "repeat(concat('text ', id), 20) as document")
    store.replace(rows, "post_id")
    keys = [f"p{i}" for i in range(0, 40_000, 2_000)]
    found = store.lookup([*keys, "absent", keys[0]], "post_id")
    assert rows_of(found, "post_id") == sorted((k,) for k in keys)
    one = store.lookup(["p77"], "post_id")
    # One folder of eight.
    assert one.count() == 1 and sum(rows_scanned(one).values()) <= 40_000 / 8 * 1.1
    absent = store.lookup(["q"], "post_id")
    assert rows_of(absent) == [] and sum(rows_scanned(absent).values()) == 0
    assert store.lookup([], "post_id").count() == 0
    store.upsert(spark.createDataFrame([(None, 1, "x")], "post_id string, n long, document string"), "post_id")
    assert rows_of(store.lookup([None, "p5"], "post_id"), "n") == [(1,), (5,)]


def test_sorted_files_are_skipped_by_score(spark, path):
    from postmill.plans.late_top import rows_near_top

    rows = spark.range(0, 300_000, 1, 2).selectExpr("concat('g', id % 2) as subreddit", "id * 7919 % 300007 as score", "repeat('body ', 10) as body")
    read = {}
    for name, order in (("plain", []), ("sorted", [F.desc_nulls_last("score")])):
        tables.overwrite_table(rows, path(name), "subreddit", sort_by=order)
        near = rows_near_top(tables.read_table(spark, path(name), rows.schema), "subreddit", "score", 10)
        assert near.count() == 20
        read[name] = sum(n for columns, n in rows_scanned(near).items() if "body" in columns)
    # Pages of 20,000 rows: one per file is left of all.
    assert read["plain"] > 250_000 and read["sorted"] <= 100_000


def test_rows_at_places(spark, path, monkeypatch):
    spark.range(100_000).withColumn("g", F.col("id") % 3).repartition(2).write.partitionBy("g").parquet(path("t"))
    table = tables.with_places(spark.read.parquet(path("t")))
    wanted = F.col("id").isin([0, 5, 32_767, 32_768, 65_536, 99_999]) | (F.pmod(F.hash("id"), F.lit(7)) == 0) & (F.col("id") < 60_000)
    places = table.filter(wanted).select("_file", "_row")
    for most in (1 << 14, 0):
        monkeypatch.setattr(tables, "MOST_BITMAPS", most)
        for there, expected in ((True, table.filter(wanted)), (False, table.filter(~wanted))):
            found = tables.rows_at(table, places, there)
            assert found.columns == table.columns
            assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    assert tables.rows_at(table, places.limit(0)).isEmpty() and tables.rows_at(table, places.limit(0), there=False).count() == 100_000
    # No row of the table is moved.
    monkeypatch.setattr(tables, "MOST_BITMAPS", 1 << 14)
    assert records_shuffled(tables.rows_at(table, places)) == 0
