"""What the operators share: tables, staging, and vectorised handling of text bytes."""

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postmill.session import scratch_path

# Text handed to numpy at a time; bounds the memory of a task whatever the rows are.
CHUNK_BYTES = 1 << 20
# Bytes of rows that an Arrow function gets at a time, where the session does not say.
BATCH_BYTES = 4 << 20
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: what is used more than once
    is computed once, and a lost executor does not lose it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Arrow functions of this session get their rows in batches of about ``BATCH_BYTES``; a limit that was set stays.

    Spark's own limits are 10,000 rows and 64 MB, which an executor holds several times over for each of its tasks.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def with_fields(docs: DataFrame, columns: Sequence[str], added: str) -> StructType:
    """The schema of some columns of ``docs``, of any name, and of ``added`` ones, as DDL."""
    return StructType([docs.schema[c] for c in columns] + StructType.fromDDL(added).fields)


def fresh(columns: Sequence[str], name: str) -> str:
    """``name``, or with as many more underscores as no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(columns: Sequence[str]) -> list[str]:
    """Columns of any name, for a select."""
    return ["`" + c.replace("`", "``") + "`" for c in columns]


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds, F.lit(0))


def fold_of(doc_id: int | None, folds: int) -> int:
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about ``limit`` bytes; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(batch):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def words_of(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and how many each text has (null: none).

    Words are split at ASCII white space only, and only A-Z is lowered.
    """
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = pc.list_flatten(lists)
    row = pc.list_parent_indices(lists)
    # White space at either end of a text leaves an empty word.
    real = pc.greater(pc.binary_length(flat), 0)
    row = row.filter(real).to_numpy(zero_copy_only=False)
    return flat.filter(real), np.bincount(row, minlength=len(texts)).astype(np.int64)


def encoded_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Word numbers in order, the distinct words they number, and words per text."""
    words, counts = words_of(texts)
    coded = pc.dictionary_encode(words)
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, counts


def flat_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings in one array, and the n + 1 offsets into it."""
    strings = pc.fill_null(strings, "")
    if not len(strings):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(strings.type) else np.int32
    offsets = np.frombuffer(strings.buffers()[1], kind)[strings.offset : strings.offset + len(strings) + 1]
    offsets = offsets.astype(np.int64)
    data = strings.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


# Any odd multiplier has an inverse modulo 2**64, so the hash of a span follows from prefix sums.
_MULTIPLIER = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(1 << 16, 1 << int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        both = []
        for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            both.append(np.multiply.accumulate(powers))
        _powers[size] = (both[0], both[1])
    return _powers[size]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span stands."""
    powers, inverse = _power_table(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts])


def spread_join(many: DataFrame, few: DataFrame, key: str, rows: str, by: str, hot_keys: int = 10_000) -> DataFrame:
    """Inner join of ``many`` with ``few``, which has each key once and in ``rows`` how many rows of ``many`` have it.

    A key with more than 1 / ``hot_keys`` of all rows is spread: its row of ``few`` is repeated for so many parts, and the rows
    of ``many`` are dealt among them by a hash of ``by``. There cannot be more than ``hot_keys`` such keys, which bounds what is
    broadcast. ``rows`` is left out of the result.
    """
    share = F.greatest(F.lit(100), F.ceil(few.agg(F.coalesce(F.sum(rows), F.lit(0)) / hot_keys).scalar()))
    sized = few.withColumn("_parts", F.ceil(F.col(rows) / share).cast("int")).drop(rows)
    hot = F.broadcast(sized.filter("_parts > 1").select(key, "_parts"))
    part = F.pmod(F.xxhash64(by), F.coalesce("_parts", F.lit(1))).cast("int")
    dealt = many.join(hot, key, "left").withColumn("_part", part).drop("_parts")
    repeated = sized.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    return dealt.join(repeated, [key, "_part"]).drop("_part")


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Connected components of ``edges`` (a, b): node and the component's smallest node.

    Each round links every node's larger neighbours to its smallest one (large star) and then
    its smaller neighbours to the smallest (small star); rounds grow with the logarithm of the size. A
    star's edges and its centers are written out, so that the driver plans each step by itself; the edges
    of a large star's center are spread.
    """

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        if larger:
            pairs = pairs.union(pairs.select("b", "a"))
        else:
            pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = pairs.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("rows")).withColumn("m", F.least("a", "m"))
        least = staged(least, "centers")
        joined = spread_join(pairs, least, "a", "rows", "b")
        moved = joined.filter("b > a" if larger else "b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not larger:
            moved = moved.union(least.select("a", F.col("m").alias("b")))
        return staged(moved.filter("a <> b").distinct(), "edges")

    current = staged(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    for _ in range(max_rounds):
        current = star(star(current, True), False)
        # Settled are edges that all lead from a node with no other one to the smallest of its component.
        both = current.select(F.col("a").alias("node"), F.lit(1).alias("ends")).union(current.select("b", F.lit(0)))
        met = both.groupBy("node").agg(F.sum("ends").alias("ends"), F.min("ends").alias("least"))
        if not met.filter("ends > least").count():
            break
    else:
        raise RuntimeError("components did not settle")
    ends = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return ends.union(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def may_be_among(keys: DataFrame, key: str, most_bits: int = 28):
    """An Arrow function of 64-bit hashes: False only for those that are not in column ``key`` of ``keys``.

    A bitmap of about 16 bits per key and at most 2**``most_bits`` (32 MB); one that is too full lets more pass, never less.
    """
    spark = keys.sparkSession
    bits = 1 << min(most_bits, max(16, int(16 * keys.count()).bit_length()))
    bit = F.pmod(F.col(key), F.lit(bits))
    words = keys.groupBy((bit / 32).cast("int").alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, int(pmod({key}, 32)))")).alias("set")).toArrow()
    found = np.zeros(bits // 32, "<u4")
    found[words["at"].to_numpy()] = words["set"].to_numpy().astype(np.uint32)
    shared = spark.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bitmap = shared.value
        for batch in batches:
            at = batch.to_numpy(zero_copy_only=False) & (bits - 1)
            yield pa.array((bitmap[at >> 5] >> (at & 31).astype(np.uint32) & 1) > 0)

    return F.arrow_udf(_typed(run), "boolean")


def _typed(run):
    """``run`` as a function from iterator to iterator, which is told by its annotations."""

    def batches(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from run(arrays)

    return batches
