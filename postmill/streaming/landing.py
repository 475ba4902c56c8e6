"""Bronze ingestion as a file stream: each run takes the page files landed since the last."""

import hashlib

from pyspark.sql import DataFrame, SparkSession

from postmill.plans.jobs import ingest_landed
from postmill.schema import PAGE_DDL


def ingest_landed_pages(
    spark: SparkSession,
    landing_path: str,
    bronze_path: str,
    checkpoint_path: str,
    rejects_path: str | None = None,
) -> None:
    """Append the posts of all new page files to bronze, and what it cannot take to a table of rejects, then stop.

    A batch is one of bronze's batches, named after the stream's progress folder and its number, and replaces
    itself when it is run again, so a run that breaks off between writing and committing leaves no second
    copy. A stream keeps all posts: how its files land must not decide which.
    """
    stream = hashlib.md5(checkpoint_path.encode()).hexdigest()[:12]

    def write(pages: DataFrame, batch: int) -> None:
        ingest_landed(pages, bronze_path, rejects_path, batch=f"{stream}-{batch}")

    pages = spark.readStream.schema(PAGE_DDL).json(landing_path)
    query = (
        pages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
