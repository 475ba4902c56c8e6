"""Bronze to silver, silver to gold, silver to vectors, and all of them in order."""

import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postmill import settings
from postmill.functions.text import first_chars
from postmill.functions.vectors import EncoderFactory
from postmill.operators import gold
from postmill.operators.embed import embed_posts, encode_query
from postmill.operators.search import with_bucket
from postmill.operators.silver import silver_of_latest, silver_posts
from postmill.plans.late_top import rows_near_top
from postmill.plans.latest import latest_rows
from postmill.schema import SILVER_DDL, bronze_columns
from postmill.sources.listing import cap_per_channel, landed_posts, reject_rows
from postmill.sources.tables import KeyedTable, append_batch, append_bronze, overwrite_table, read_bronze, records_to_bronze, staged, with_places


def silver_order() -> list[Column]:
    """Best first within a file of a group, so that ``rows_near_top`` skips most of it."""
    return [F.desc_nulls_last("score")]



def ingest_to_bronze(spark: SparkSession, records: Iterable[dict], bronze_path: str, fmt: str = "parquet") -> int:
    """Append records held by the caller."""
    return append_bronze(records_to_bronze(spark, records), bronze_path, fmt)


def ingest_landed(
    pages: DataFrame, bronze_path: str, rejects_path: str | None = None, limit: int | None = None, fmt: str = "parquet", batch: str | None = None
) -> dict[str, int]:
    """Append the posts of landed pages to bronze and what it cannot take to a table of rejects; counts of both.

    The pages are parsed once, into a written table that both appends read. All posts are kept unless a ``limit`` per channel
    and fetch is asked for. Rejects carry their reason and their source (see ``landed_posts``); without a path they are only counted. A
    ``batch`` that is ingested again under its name replaces itself in both tables.
    """
    landed = staged(landed_posts(pages), "landed")
    rejected = reject_rows(landed)
    posts = landed.filter("reason is null").drop("reason", "source")
    if limit is not None:
        posts = cap_per_channel(posts, limit)
    rows = {"rejected": append_batch(rejected, rejects_path, fmt, batch) if rejects_path else rejected.count()}
    # A folder without rows is left out, unless it replaces one.
    if batch is not None or not posts.isEmpty():
        rows["posts"] = append_bronze(posts.select(*bronze_columns()), bronze_path, fmt, batch)
    return {"posts": 0, **rows}


def ingest_pages(pages: DataFrame, bronze_path: str, limit: int | None = None, fmt: str = "parquet", rejects_path: str | None = None) -> int:
    """``ingest_landed`` for a fetch that must bring posts: one without any is an error, and adds nothing to bronze."""
    rows = ingest_landed(pages, bronze_path, rejects_path, limit, fmt)
    if not rows["posts"]:
        raise ValueError("the pages hold no posts")
    return rows["posts"]


def transform_bronze_to_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    schema: StructType | str | None = None,
    rebalance: bool = True,
    fmt: str = "parquet",
) -> int:
    """Rebuild silver. With ``schema``, bronze's file footers need not be merged first.

    ``rebalance`` is explained at ``overwrite_table``; here it comes before the derived columns. Copies of Parquet rows are
    told apart by narrow columns and places (``latest_rows``).
    """
    bronze, rebalance_by = read_bronze(spark, bronze_path, schema, fmt), "subreddit" if rebalance else None
    if fmt == "parquet":
        silver = silver_of_latest(latest_rows(with_places(bronze))[0], rebalance_by)
    else:
        silver = silver_posts(bronze, rebalance_by)
    return overwrite_table(silver, silver_path, "subreddit", rebalance=False, fmt=fmt, sort_by=silver_order())


def transform_silver_to_gold(spark: SparkSession, silver_path: str, gold_path: str, fmt: str = "parquet") -> dict[str, int]:
    """Write the five gold tables and return their row counts.

    Silver is not cached: each table's scan reads only its own narrow columns. The writes do
    not depend on each other and are submitted together, so one's last tasks overlap with the
    next one's first.
    """
    silver = spark.read.format(fmt).schema(SILVER_DDL).load(silver_path)
    near_top = rows_near_top(silver, "subreddit", "score", settings.TOP_POSTS)
    tables = {name: build(silver) for name, build in gold.ROLLUPS.items()}
    tables["top_posts"] = gold.build_top_posts(near_top)
    with ThreadPoolExecutor(len(tables)) as pool:
        writes = {
            name: pool.submit(inheritable_thread_target(spark)(overwrite_table), df, f"{gold_path}/{name}", fmt=fmt)
            for name, df in tables.items()
        }
        return {name: write.result() for name, write in writes.items()}


def build_vector_store(
    spark: SparkSession,
    silver_path: str,
    vector_path: str,
    top_n: int = settings.EMBED_TOP,
    encoder: EncoderFactory | None = None,
    batch_size: int = settings.EMBED_BATCH,
    max_chars: int | None = None,
    replace: bool = False,
    fmt: str = "parquet",
    bits: int | None = None,
    encoder_name: str = "",
) -> int:
    """Embed the best posts of each group and upsert them by id; returns the table's rows.

    Only texts that the table does not hold for their post are encoded, told by a digest of the text and ``encoder_name``:
    give another encoder another name. A post whose text is stored and whose group or title changed keeps its vector, and one that is
    stored as it is stays untouched. Posts that left the top stay in the table unless ``replace`` is set, which encodes all anew. With
    ``bits`` the table is stored by bucket for approximate search; a table keeps its layout until it is replaced.
    """
    silver = spark.read.format(fmt).schema(SILVER_DDL).load(silver_path)
    candidates = gold.embedding_candidates(rows_near_top(silver, "subreddit", "score", top_n), top_n)
    text = F.coalesce(first_chars("content", max_chars), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{encoder_name}:"), text).cast("binary"), 256)
    candidates = staged(candidates.withColumn("text_digest", digest), "candidates")
    table = KeyedTable(spark, vector_path)
    stored = None if replace or not table.exists() else table.read()
    known = stored is not None and "text_digest" in stored.columns
    unseen = candidates
    if known:
        held = stored.select("post_id", "text_digest", F.struct("subreddit", "title").alias("held"))
        met = candidates.join(held, ["post_id", "text_digest"], "left")
        unseen = met.filter("held is null").select(*candidates.columns)
        moved = met.filter("held is not null").filter(~F.col("held.subreddit").eqNullSafe(F.col("subreddit")) | ~F.col("held.title").eqNullSafe(F.col("title")))
    records = embed_posts(unseen, encoder, batch_size, max_chars, spark.sparkContext.defaultParallelism, keep=["text_digest"])
    if known:
        kept = moved.select("post_id", "subreddit", "title").join(stored.drop("subreddit", "title", "bucket"), "post_id")
        records = records.unionByName(kept.select(*records.columns))
    if bits is not None:
        records = with_bucket(records, bits, len(encode_query("", encoder)))
    partition_by = None if bits is None else "bucket"
    return table.replace(records, "post_id", partition_by) if replace else table.upsert(records, "post_id", partition_by)


def run_all(
    spark: SparkSession,
    pages: DataFrame,
    root: str,
    encoder: EncoderFactory | None = None,
    report: Callable[[str], None] = print,
    limit: int | None = None,
    max_chars: int | None = None,
    bits: int | None = None,
    encoder_name: str = "",
) -> dict[str, object]:
    """All steps in order in one session. A failing step raises, and no later one starts.

    What ingestion rejects goes to a table ``rejects`` below the root; the result also counts it, as ``rejected``. Columns that
    batches of bronze have beyond its own are kept up to silver.
    """
    root = root.rstrip("/")
    rejected = {}

    def bronze() -> int:
        counts = ingest_landed(pages, f"{root}/bronze", f"{root}/rejects", limit)
        if not counts["posts"]:
            raise ValueError("the pages hold no posts")
        rejected.update(counts)
        return counts["posts"]

    steps = {
        "bronze": bronze,
        "silver": lambda: transform_bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver"),
        "gold": lambda: transform_silver_to_gold(spark, f"{root}/silver", f"{root}/gold"),
        "vectors": lambda: build_vector_store(
            spark, f"{root}/silver", f"{root}/vectors", encoder=encoder, max_chars=max_chars, bits=bits, encoder_name=encoder_name
        ),
    }
    rows = {}
    for name, step in steps.items():
        started = time.monotonic()
        rows[name] = step()
        report(f"{name}: {rows[name]} rows in {time.monotonic() - started:.1f} s")
    rows["rejected"] = rejected["rejected"]
    return rows
