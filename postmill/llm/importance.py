"""Importance resampling towards a target distribution: hashed features, array scores, distributed quickselect.

Every text is a bag of features, the runs of 1 to ``RUNS`` words, each hashed into one of ``BUCKETS``
buckets. A bucket's gain is the logarithm of its share in the target over its share in the corpus; a
document's weight is the mean gain of its features, read from one array. Gumbel noise derived from the id is
added to the weight, so that the highest scores are a draw without replacement in proportion to the weights.

The draw is a quickselect over all rows: keys drawn at random cut the candidates into classes, their exact sizes
(below, equal to and above each pivot) tell which class holds the k-th key, and only that class goes on as
a written table. Rows up to the k-th key are the winners; they alone are range-partitioned, sorted and ranked. What
comes to the driver are bucket counts, class sizes, pivots and rows per partition, all bounded by parameters.

Defined results: a null or wordless text has no feature and weight 0. Ties go to the smaller id, then to
fewer features; rows without id come last among their equals and draw their noise for the empty id. Rows that repeat
are drawn, and ranked, each for itself. Without a target, or without a corpus, smoothing leaves every gain defined.
"""

import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.common import encoded_words, flat_bytes, slices, staged

RUNS = 1
BUCKETS = 10_000
SALT = "2024"
PERCENT = 10
MIN_WORDS = 20
PIVOTS = 16
# A-Z as a-z; every other ASCII character that is neither digit nor letter as a space.
_AS_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if chr(c).isalnum() or c >= 0x80 else 0x20 for c in range(256))


def plain_words(texts: pa.Array) -> pa.Array:
    """The texts with A-Z lowered and white space for all that separates words; no byte moves."""
    data, offsets = flat_bytes(texts)
    swapped = data.tobytes().translate(_AS_WORDS)
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(swapped)])


def features(texts: pa.Array, runs: int = RUNS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features by text, and how many features and words each text has."""
    codes, distinct, n_words = encoded_words(plain_words(texts))
    names = [w.encode() for w in distinct.to_pylist()]
    rows = np.repeat(np.arange(len(texts)), n_words)
    one = np.array([zlib.crc32(w) % buckets for w in names], np.int64)
    of_row, found = [rows], [one[codes]]
    for length in range(2, runs + 1):
        if len(codes) < length:
            break
        inside = rows[: len(rows) - length + 1] == rows[length - 1 :]
        spans = np.lib.stride_tricks.sliding_window_view(codes, length)[inside]
        unique, place = np.unique(spans, axis=0, return_inverse=True)
        hashed = np.array([zlib.crc32(b" ".join(names[i] for i in span)) % buckets for span in unique.tolist()], np.int64)
        of_row.append(rows[: len(rows) - length + 1][inside])
        found.append(hashed[place.ravel()])
    of_row, found = np.concatenate(of_row), np.concatenate(found)
    if runs > 1:
        found = found[np.argsort(of_row, kind="stable")]
    return found, np.bincount(of_row, minlength=len(texts)).astype(np.int64), n_words


def bucket_counts(texts: DataFrame, text_column: str = "text", runs: int = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket; a task sends each of its buckets once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, text_column):
                total += np.bincount(features(part[text_column], runs, buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": used, "n": total[used]})

    found = texts.select(text_column).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in found.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the natural logarithm of each bucket's smoothed share in the target over that in the corpus."""
    s, t, width = corpus.astype(np.float64), target.astype(np.float64), float(len(corpus))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + width) / ((s + 1) * (t.sum() + width)))).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, text_column: str = "text", runs: int = RUNS) -> DataFrame:
    """``docs`` without its text, with ``n_features``, ``n_words`` and ``weight``, in columns of a struct ``drawn``."""
    kept = [f for f in docs.schema if f.name != text_column]
    shape = "struct<n_features: bigint, n_words: bigint, weight: bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, n, n_words = features(part["text"], runs, len(gain))
                sums = np.concatenate([[0], np.cumsum(gain[found])])
                ends = np.cumsum(n)
                weight = (sums[ends] - sums[ends - n]) // np.maximum(n, 1)
                drawn = pa.StructArray.from_arrays([pa.array(a) for a in (n, n_words, weight)], ["n_features", "n_words", "weight"])
                yield pa.RecordBatch.from_arrays([part["row"], drawn], ["row", "drawn"])

    whole = F.struct(*(F.col(f"`{f.name}`") for f in kept)) if kept else F.struct(F.lit(0).alias("none"))
    rows = docs.select(whole.alias("row"), F.col(text_column).alias("text"))
    schema = rows.select("row", F.lit(None).cast(shape).alias("drawn")).schema
    return rows.mapInArrow(run, schema).select(*(F.col(f"row.`{f.name}`").alias(f.name) for f in kept), "drawn")


def noise(id_column: str, salt: str = SALT) -> Column:
    """Thousandths of a standard Gumbel draw that only the id and ``salt`` decide."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def kth_key(rows: DataFrame, fields: Sequence[str], k: int, pivots: int = PIVOTS) -> tuple | None:
    """The ``k``-th smallest (from 1) of the composite keys ``fields``, none of them null; None if there are fewer.

    A round draws its pivots by the least hash of key and round, takes the exact sizes of the classes between and
    at them, and goes on with the class that holds the k-th key, written out. A pivot leaves the candidates, so it ends.
    """
    key = F.struct(*fields)
    candidates, turn = rows.select(*fields), 0
    while True:
        drawn = candidates.orderBy(F.xxhash64(F.lit(turn), *fields)).limit(pivots).collect()
        if not drawn:
            return None
        cuts = sorted({tuple(row) for row in drawn})
        # A class is twice the number of pivots below, and one more for a key equal to one.
        known = [_literal(rows, fields, cut) for cut in cuts]
        place = reduce(Column.__add__, [(key > p).cast("int") + (key >= p).cast("int") for p in known])
        for row in sorted(candidates.groupBy(place.alias("class")).count().collect()):
            if k <= row["count"]:
                break
            k -= row["count"]
        else:
            return None
        below, at_pivot = divmod(row["class"], 2)
        if at_pivot:
            return cuts[below]
        inside = [key > p for p in known[:below][-1:]] + [key < p for p in known[below:][:1]]
        candidates, turn = staged(candidates.filter(reduce(Column.__and__, inside)), "candidates"), turn + 1


def _literal(rows: DataFrame, fields: Sequence[str], values: tuple) -> Column:
    return F.struct(*(F.lit(v).cast(rows.schema[f].dataType).alias(f) for f, v in zip(fields, values, strict=True)))


def ranked(rows: DataFrame, fields: Sequence[str], rank: str) -> DataFrame:
    """``rows`` with their place (from 1) in the order of ``fields``.

    Rows are dealt by range; equal ones too, by chance, so that no number of copies meets in one task. A
    row's place is its place within its range after the sizes of the ranges before it.
    """
    spark = rows.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("_chance", F.rand(7)).repartitionByRange(width, *fields, "_chance")
    dealt = staged(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    before, offsets = 0, []
    for row in dealt.groupBy("_range").count().orderBy("_range").collect():
        offsets.append((row["_range"], before))
        before += row["count"]
    # One row per partition of the range shuffle.
    starts = F.broadcast(spark.createDataFrame(offsets, "_range int, _before long"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*fields, "_chance"))
    return dealt.join(starts, "_range").withColumn(rank, place + F.col("_before")).drop("_range", "_before", "_chance")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    runs: int = RUNS,
    buckets: int = BUCKETS,
    salt: str = SALT,
    text_column: str = "text",
    id_column: str = "doc_id",
) -> DataFrame:
    """Every row of ``docs``: its id, ``n_features``, ``weight``, ``score`` and ``rank``, null where it is not drawn.

    Of the rows with at least ``min_words`` words, ``percent`` in a hundred are drawn, rounded down.
    """
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    gain = gains(bucket_counts(texts, runs=runs, buckets=buckets), bucket_counts(target.select(F.col(text_column).alias("text")), runs=runs, buckets=buckets))
    found = weighted(texts, gain, runs=runs).select("id", "drawn.*")
    scored = found.withColumn("score", F.col("weight") + noise("id", salt))
    fields = ["_worse", "_nameless", "_id", "n_features"]
    keyed = staged(
        scored.withColumns(
            {
                "_worse": -F.col("score"),
                "_nameless": F.col("id").isNull(),
                "_id": F.coalesce("id", F.lit(0).cast(docs.schema[id_column].dataType)),
                "_allowed": F.col("n_words") >= min_words,
            }
        ),
        "scored",
    )
    out = [F.col("id").alias(id_column), "n_features", "weight", "score"]
    allowed = keyed.filter("_allowed")
    k = allowed.count() * percent // 100
    last = kth_key(allowed, fields, k) if k else None
    unranked = F.lit(None).cast("long").alias("rank")
    if last is None:
        return keyed.select(*out, unranked)
    wins = F.col("_allowed") & (F.struct(*fields) <= _literal(keyed, fields, last))
    winners = ranked(keyed.filter(wins), fields, "rank")
    # Copies of the k-th row may reach beyond k.
    drawn = F.when(F.col("rank") <= k, F.col("rank")).cast("long").alias("rank")
    return winners.select(*out, drawn).unionAll(keyed.filter(~wins).select(*out, unranked))
