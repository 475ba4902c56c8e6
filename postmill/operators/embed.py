"""Text to vector records: post_id, subreddit, title, document, embedding."""

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill import settings
from postmill.functions.text import first_chars
from postmill.functions.vectors import EncoderFactory, encode_with, hashing_encoder


def embed_posts(
    posts: DataFrame,
    encoder: EncoderFactory | None = None,
    batch_size: int = settings.EMBED_BATCH,
    max_chars: int | None = None,
    partitions: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Encode ``content`` on the executors; only that column goes to Python. Columns to ``keep`` are passed on.

    Whole texts are encoded and stored unless ``max_chars`` is given, for a model that reads no more. A small input out of a ranking sits in few partitions: ``partitions``
    spreads it, which pays when the encoder is a model.
    """
    if partitions:
        posts = posts.repartition(partitions)
    documents = posts.withColumn("document", first_chars("content", max_chars))
    embed = encode_with(encoder or hashing_encoder(), batch_size)
    return documents.select(
        "post_id", "subreddit", "title", "document", embed(F.col("document")).alias("embedding"), *keep
    )


def encode_query(text: str, encoder: EncoderFactory | None = None) -> list[float]:
    """The vector of one query text, made on the driver by the same encoder."""
    vector = (encoder or hashing_encoder())()([text])[0]
    return np.asarray(vector, dtype=np.float32).tolist()
