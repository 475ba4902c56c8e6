import math

import numpy as np
import pytest
from helpers import plan_of, records_shuffled, rows_of
from postmill.checks import fixtures
from postmill.functions import vectors as v
from postmill.operators import search
from postmill.operators.embed import embed_posts
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def posts_of(spark, **contents):
    rows = [(k, "g", f"title {k}", c) for k, c in contents.items()]
    return spark.createDataFrame(rows, "post_id string, subreddit string, title string, content string")


def records(spark, **embeddings):
    rows = [(k, "g", f"title {k}", f"text {k}", e) for k, e in embeddings.items()]
    return spark.createDataFrame(
        rows, "post_id string, subreddit string, title string, document string, embedding array<float>"
    )


def random_vectors(spark, n, dimension=6, seed=1, copies=1):
    values = np.random.default_rng(seed).normal(size=(n, dimension)).astype(np.float32)
    values = np.repeat(values, copies, axis=0)
    rows = [(i, x.tolist()) for i, x in enumerate(values)]
    return values, spark.createDataFrame(rows, "post_id bigint, embedding array<float>").repartition(5)


def brute_force(values, query, k):
    a, q = values.astype(np.float64), np.asarray(query, dtype=np.float64)
    similarity = np.round(a @ q / np.linalg.norm(a, axis=1) / np.linalg.norm(q), 9)
    return sorted(range(len(a)), key=lambda i: (-similarity[i], i))[:k]


# Encoders


def test_hashing_encoder_counts_words():
    encode = v.hashing_encoder(8)()
    one, same, none = encode(["The cat, the CAT!", "cat the cat the", "é 中 -"])
    assert one.tolist() == same.tolist()
    assert math.isclose(np.linalg.norm(one), 1.0)
    assert not none.any()


def test_words_are_hashed_by_md5():
    # md5("spark") starts with 98f11b7, and 0x98f11b7 % 64 == 55.
    import hashlib

    expected = int(hashlib.md5(b"spark").hexdigest()[:7], 16) % 64
    assert v.hashing_encoder()()(["Spark"])[0].argmax() == expected


def length_encoder():
    """A stand-in for a model: length, and how many texts came in this call."""
    return lambda: lambda texts: np.array([[len(t), len(texts)] for t in texts])


def test_encoder_is_a_parameter_and_gets_bounded_batches(spark):
    posts = posts_of(spark, **{f"p{i:03d}": "x" * i for i in range(600)}).coalesce(1)
    found = rows_of(embed_posts(posts, length_encoder(), batch_size=256), "post_id", "embedding")
    assert [e[0] for _, e in found] == list(range(600))
    assert sorted({e[1] for _, e in found}) == [88.0, 256.0]


def test_documents_are_cut_only_as_asked(spark):
    posts = posts_of(spark, a="\U0001f600" * 3000, b="short", c=None)
    stock = embed_posts(posts, length_encoder(), max_chars=2000)
    assert rows_of(stock.filter("document is not null").select("post_id", F.length("document"))) == [("a", 2000), ("b", 5)]
    whole = embed_posts(posts, length_encoder())
    assert whole.filter("post_id = 'a'").head().embedding[0] == 3000
    assert stock.filter("post_id = 'c'").head().embedding is None


def test_encoder_is_loaded_once_per_task_and_not_per_batch(spark, tmp_path):
    def counting():
        from uuid import uuid4

        (tmp_path / uuid4().hex).touch()
        return lambda texts: np.ones((len(texts), 1))

    embed_posts(posts_of(spark, **{f"p{i}": "x" for i in range(50)}), counting, batch_size=2, partitions=3).collect()
    assert 1 <= len(list(tmp_path.iterdir())) <= 3


def test_filter_on_the_vector_does_not_encode_twice(spark):
    embedded = embed_posts(posts_of(spark, a="x")).filter("size(embedding) > 0 and embedding is not null")
    assert plan_of(embedded).count("ArrowEvalPython") == 1


def test_empty_input(spark):
    assert embed_posts(posts_of(spark, a="x").limit(0)).collect() == []


# Search


def test_nearest_equals_brute_force(spark):
    values, df = random_vectors(spark, 300, copies=2)
    for seed in range(3):
        query = np.random.default_rng(seed).normal(size=6).tolist()
        found = search.nearest(df, query, 7).orderBy("rank").collect()
        assert [r.post_id for r in found] == brute_force(values, query, 7)
        assert [r.rank for r in found] == list(range(1, 8))
        assert all(math.isclose(r.similarity + r.distance, 1) for r in found)


def test_a_vector_finds_itself(spark):
    values, df = random_vectors(spark, 50)
    best = search.nearest(df, (values[7] * 3).tolist(), 1).head()
    assert best.post_id == 7
    assert math.isclose(best.similarity, 1, abs_tol=1e-9)


def test_vectors_without_direction_are_left_out(spark):
    df = records(spark, zero=[0.0, 0.0], none=None, long=[1.0, 0.0, 0.0], good=[0.0, -2.0])
    assert rows_of(search.nearest(df, [0.0, 1.0], 5), "post_id", "similarity") == [("good", -1.0)]
    assert rows_of(df.select("post_id", v.cosine_to([0.0, 1.0])("embedding").alias("s")).filter("s is null"), "post_id") == [
        ("long",), ("none",), ("zero",)
    ]


def test_group_filter_comes_before_the_ranking(spark):
    df = records(spark, a=[1.0, 0.0], b=[0.9, 0.1], c=[0.0, 1.0]).withColumn(
        "subreddit", F.when(F.col("post_id") == "c", "h").otherwise("g")
    )
    assert rows_of(search.search(df, [1.0, 0.0], 2, "h"), "post_id", "rank") == [("c", 1)]
    for everything in (None, ""):
        assert search.search(df, [1.0, 0.0], 9, everything).count() == 3
    for no_group in ("no such group", "All"):
        assert search.search(df, [1.0, 0.0], 9, no_group).count() == 0


def test_text_search_and_presentation(spark):
    posts = posts_of(spark, a="green tea and cake", b="black coffee " + "z" * 3000, c="tea")
    found = search.search_text(embed_posts(posts), "Green tea", 2)
    assert found.columns == ["rank", "post_id", "content", "subreddit", "title", "similarity", "distance"]
    assert [r.post_id for r in found.orderBy("rank").collect()] == ["a", "c"]
    shown = search.presented(search.search_text(embed_posts(posts), "coffee", 1)).head()
    assert (shown.position, shown.link, len(shown.preview)) == (1, "https://reddit.com/comments/b", 1500)
    assert shown.match_percent == round(shown.match_percent, 1) > 50


@pytest.mark.parametrize("per_cell", [4096, 6, 1])
def test_batch_search_equals_single_searches(spark, per_cell):
    values, df = random_vectors(spark, 200, copies=3)
    asked, queries = random_vectors(spark, 20, seed=5)
    queries = queries.withColumnRenamed("post_id", "query_id")
    found = search.nearest_batch(df, queries, 4, queries_per_cell=per_cell)
    by_query = {}
    for r in found.orderBy("query_id", "rank").collect():
        by_query.setdefault(r.query_id, []).append(r.post_id)
    assert by_query == {i: brute_force(values, asked[i], 4) for i in range(20)}


def test_batch_search_over_many_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        values, df = random_vectors(spark, 600)
        queries = spark.createDataFrame([("q", [1.0] * 6), ("none", None)], "query_id string, embedding array<float>")
        found = search.nearest_batch(df.coalesce(1), queries, 9).orderBy("rank").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(r.query_id, r.post_id) for r in found] == [("q", i) for i in brute_force(values, [1.0] * 6, 9)]


def test_batch_search_with_many_copies_of_one_vector(spark):
    values, _ = random_vectors(spark, 900)
    values[::3] = values[0]
    rows = [(f"v{i:03d}", x.tolist()) for i, x in reversed(list(enumerate(values)))]
    df = spark.createDataFrame(rows, "post_id string, embedding array<float>")
    queries = spark.createDataFrame([(1, values[0].tolist())], "query_id int, embedding array<float>")
    for parts in (1, 7):
        found = search.nearest_batch(df.repartition(parts), queries, 20).orderBy("rank").collect()
        assert [r.post_id for r in found] == [f"v{3 * i:03d}" for i in range(20)]


@pytest.mark.parametrize("cells", [1, 64, 1000])
def test_batch_search_in_small_blocks(spark, monkeypatch, cells):
    monkeypatch.setattr(search, "CELLS_AT_A_TIME", cells)
    values, df = random_vectors(spark, 300, copies=2)
    asked, queries = random_vectors(spark, 7, seed=3)
    found = search.nearest_batch(df, queries.withColumnRenamed("post_id", "query_id"), 5).orderBy("query_id", "rank")
    expected = [(i, x) for i in range(7) for x in brute_force(values, asked[i], 5)]
    assert [(r.query_id, r.post_id) for r in found.collect()] == expected


def test_batch_search_with_rising_similarities(spark):
    angles = np.linspace(3.0, 0.0, 2000)
    rows = [(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(angles)]
    df = spark.createDataFrame(rows, "post_id int, embedding array<float>").coalesce(1)
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<float>")
    found = search.nearest_batch(df, queries, 3).orderBy("rank").collect()
    assert [r.post_id for r in found] == [1999, 1998, 1997]


def test_queries_without_direction_find_nothing(spark):
    df = records(spark, a=[1.0, 0.0])
    assert search.search(df, [0.0, 0.0]).count() == 0
    assert search.search_text(embed_posts(posts_of(spark, a="tea")), "???").count() == 0
    queries = spark.createDataFrame([(1, [0.0, 0.0])], "query_id int, embedding array<float>")
    assert search.search_batch(df, queries).count() == 0


def test_batch_search_looks_up_columns_by_broadcast(spark):
    df = records(spark, a=[1.0, 0.0], b=[0.6, 0.8], c=[0.0, 1.0])
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0])], "query_id int, embedding array<float>")
    found = search.search_batch(df, queries, 2, "g")
    assert sorted(found.columns) == sorted(["query_id", *search.search(df, [1.0, 0.0]).columns])
    assert rows_of(found, "query_id", "rank", "content") == [
        (1, 1, "text a"), (1, 2, "text b"), (2, 1, "text c"), (2, 2, "text b")
    ]
    assert "BroadcastHashJoin" in plan_of(found) and "SortMergeJoin" not in plan_of(found)


def test_batch_search_without_queries_or_vectors(spark):
    _, df = random_vectors(spark, 10)
    queries = df.withColumnRenamed("post_id", "query_id")
    assert search.nearest_batch(df, queries.limit(0), 3).count() == 0
    assert search.nearest_batch(df.limit(0), queries, 3).count() == 0


def test_batch_search_emits_at_most_k_rows_per_query_and_cell(spark):
    queries = spark.range(3).selectExpr("id as query", "array(1f, float(id)) as target")
    vectors = spark.range(500).selectExpr("id", "array(float(id), 1f) as vector")
    rows = spark.range(2).selectExpr("int(id) as cell").crossJoin(
        queries.unionByName(vectors, allowMissingColumns=True).withColumn("is_vector", F.col("target").isNull())
    )
    cells = rows.coalesce(1).sortWithinPartitions("cell", "is_vector")
    found = search._best_per_cell(cells.select("cell", "is_vector", "query", "target", "id", "vector"), 4)
    assert found.count() == 2 * 3 * 4


def test_batch_search_shuffles_no_vector_per_block(spark):
    values, df = random_vectors(spark, 300, copies=2)
    asked, queries = random_vectors(spark, 200, seed=7)
    found = search.nearest_batch(df, queries.withColumnRenamed("post_id", "query_id"), 2, queries_per_cell=10)
    # Queries, and what is ranked of them, in two rounds at most.
    assert records_shuffled(found) <= 200 + 2 * 200 * 2
    expected = [(i, x) for i in range(200) for x in brute_force(values, asked[i], 2)]
    assert [(r.query_id, r.post_id) for r in found.orderBy("query_id", "rank").collect()] == expected


def test_batch_search_tells_similarities_apart_that_single_precision_does_not(spark):
    angles = 0.7 + np.random.default_rng(2).permutation(3000) * 1e-8
    rows = [(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(angles)]
    df = spark.createDataFrame(rows, "post_id int, embedding array<double>")
    queries = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(2)], "query_id int, embedding array<double>")
    for per_cell in (1, 2):
        found = search.nearest_batch(df, queries, 9, queries_per_cell=per_cell).orderBy("query_id", "rank").collect()
        assert [r.post_id for r in found] == [int(i) for i in np.argsort(angles)[:9]] * 2


def test_each_query_text_is_encoded_once(spark, tmp_path):
    def counting():
        from uuid import uuid4

        load = v.hashing_encoder()()

        def encode(texts):
            (tmp_path / f"{len(texts)}-{uuid4().hex}").touch()
            return load(texts)

        return encode

    stored = embed_posts(posts_of(spark, a="green tea", b="black coffee"))
    asked = spark.createDataFrame([(i, "tea" if i % 2 else "coffee") for i in range(20)], "query_id int, text string")
    found = search.search_texts(stored, asked, 1, encoder=counting)
    assert {(r.query_id % 2, r.post_id) for r in found.collect()} == {(0, "b"), (1, "a")}
    assert sum(int(f.name.split("-")[0]) for f in tmp_path.iterdir()) == 20


def test_search_ranks_ids_and_vectors_only(spark, path):
    embed_posts(posts_of(spark, a="green tea", b="black coffee")).write.parquet(path("store"))
    plan = plan_of(search.search_text(spark.read.parquet(path("store")), "tea", 1))
    assert "ReadSchema: struct<post_id:string,embedding:array<float>>" in plan


def test_all_buckets_give_the_exact_result(spark):
    values, df = random_vectors(spark, 300)
    query = values[3].tolist()
    bucketed = search.with_bucket(df, 4, 6)
    assert bucketed.select("bucket").distinct().count() > 8
    exact = search.nearest_in_buckets(bucketed, query, 4, radius=4, k=10).orderBy("rank")
    assert [r.post_id for r in exact.collect()] == brute_force(values, query, 10)


def test_bucket_search_recall_grows_with_the_radius(spark):
    table = fixtures.table(spark, SMALL, "embeddings")
    values = np.array([r.embedding for r in table.orderBy("vec_id").collect()])
    bucketed = search.with_bucket(table, 4, 64).persist()
    recall = []
    for radius in range(5):
        hits = 0
        for i in range(10):
            found = search.nearest_in_buckets(bucketed, values[i].tolist(), 4, radius, 5, "vec_id").collect()
            hits += len({r.vec_id for r in found} & set(brute_force(values, values[i], 5)))
        recall.append(hits / 50)
    assert recall == sorted(recall)
    assert recall[0] >= 0.2 and recall[2] >= 0.8 and recall[4] == 1.0


@pytest.mark.parametrize("bits", [2, 4, 6])
def test_default_radius_finds_nine_of_ten(spark, bits):
    table = fixtures.table(spark, SMALL, "embeddings")
    values = np.array([r.embedding for r in table.orderBy("vec_id").collect()])
    bucketed = search.with_bucket(table, bits, 64).persist()
    hits = 0
    for i in range(0, 200, 20):
        found = search.nearest_in_buckets(bucketed, values[i].tolist(), bits, k=20, id_column="vec_id").collect()
        hits += len({r.vec_id for r in found} & set(brute_force(values, values[i], 20)))
    assert hits >= 0.9 * 200


def test_buckets_prune_folders(spark, path):
    values, df = random_vectors(spark, 200)
    search.with_bucket(df, 3, 6).write.partitionBy("bucket").parquet(path("b"))
    found = search.nearest_in_buckets(spark.read.parquet(path("b")), values[0].tolist(), 3, radius=0, k=1)
    assert "PartitionFilters: [isnotnull(bucket" in plan_of(found) or "PartitionFilters: [(bucket" in plan_of(found)
    assert found.head().post_id == 0
