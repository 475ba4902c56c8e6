"""Cosine k-nearest-neighbour search over vector records: exact, batched, and by LSH bucket."""

import hashlib
import itertools
import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from postmill import settings
from postmill.functions.vectors import (
    DIGITS,
    EncoderFactory,
    cosine_to,
    encode_with,
    hashing_encoder,
    rounded,
    rows_and_lengths,
    side_bits_of,
    unit,
)
from postmill.operators.embed import encode_query
from postmill.operators.ranking import top_n_per_group
from postmill.session import scratch_path
from postmill.sources.tables import KeyedTable, staged

# Query vectors compared at once by a task of the batched search, about, the most that it holds, and similarities it computes at a time.
QUERIES_PER_CELL = 4096
QUERIES_PER_TASK = 1 << 15
CELLS_AT_A_TIME = 1 << 20
# Bytes of the vectors in one row of packs, and of a row group of such rows.
PACK_BYTES = 1 << 18
PACK_GROUP_BYTES = 1 << 24


def in_group(vectors: DataFrame, group: str | int | None, column: str = "subreddit") -> DataFrame:
    """Vectors of one group; ``None`` and "" mean no filter. Prunes a table partitioned by it."""
    if group in (None, ""):
        return vectors
    return vectors.filter(F.col(column) == group)


def nearest(
    vectors: DataFrame,
    query: Sequence[float],
    k: int = settings.SEARCH_K,
    id_column: str = "post_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The ``k`` most similar rows, with ``similarity``, ``distance`` and ``rank``.

    One scan: the vector column passes through Python in Arrow batches, then each partition
    keeps its best ``k`` rows (TakeOrderedAndProject). Rows without a direction are left out.
    """
    scored = vectors.withColumn("similarity", cosine_to(query)(F.col(vector_column)))
    order = [F.desc("similarity"), F.asc(id_column)]
    best = scored.drop(vector_column).filter("similarity is not null").orderBy(*order).limit(k)
    # At most k rows are left to number in one task.
    rank = F.row_number().over(Window.orderBy(*order))
    return best.withColumns({"distance": 1 - F.col("similarity"), "rank": rank})


def search(
    vectors: DataFrame | KeyedTable,
    query: Sequence[float],
    n_results: int = settings.SEARCH_K,
    subreddit_filter: str | None = None,
    bits: int | None = None,
    radius: int | None = None,
) -> DataFrame:
    """Search vector records, whose ids are unique; the group filter applies before the ranking.

    The ranking reads ids and vectors; texts are looked up for the ``n_results`` ids found. Of a keyed table the ranking runs
    at once and its ids are pushed into a second scan, which reads the folders and row groups that hold them; a DataFrame is
    joined with what is found, and if it is not stored it is computed for both. With ``bits``, for records
    stored by bucket, only the buckets at most ``radius`` sides away are read (see ``nearest_in_buckets``).
    """
    records = vectors.read() if isinstance(vectors, KeyedTable) else vectors
    pool = in_group(records, subreddit_filter)
    if bits is not None:
        pool = in_buckets(pool, query, bits, radius)
    found = nearest(pool.select("post_id", "embedding"), query, n_results)
    if isinstance(vectors, KeyedTable):
        # At most n_results rows of two numbers and an id.
        rows = found.collect()
        pool = vectors.lookup([r["post_id"] for r in rows], "post_id")
        found = records.sparkSession.createDataFrame(rows, found.schema)
    texts = pool.select("post_id", F.col("document").alias("content"), "subreddit", "title")
    # At most n_results ids; null is one of them where a record has no id.
    found = F.broadcast(found.withColumnRenamed("post_id", "_found"))
    return texts.join(found, F.col("post_id").eqNullSafe(F.col("_found"))).select(
        "rank", "post_id", "content", "subreddit", "title", "similarity", "distance"
    )


def search_text(
    vectors: DataFrame | KeyedTable,
    text: str,
    n_results: int = settings.SEARCH_K,
    subreddit_filter: str | None = None,
    encoder: EncoderFactory | None = None,
    bits: int | None = None,
    radius: int | None = None,
) -> DataFrame:
    """Search by a text, encoded like the records were."""
    return search(vectors, encode_query(text, encoder), n_results, subreddit_filter, bits, radius)


def presented(results: DataFrame, site: str = settings.SITE, preview_chars: int = settings.PREVIEW_CHARS) -> DataFrame:
    """Search results as shown to a reader: position, percentage, preview, link."""
    return results.select(
        F.col("rank").alias("position"),
        "subreddit",
        "title",
        F.round(F.col("similarity") * 100, 1).alias("match_percent"),
        F.substring("content", 1, preview_chars).alias("preview"),
        F.concat(F.lit(f"{site}/comments/"), "post_id").alias("link"),
    )


def nearest_batch(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = settings.SEARCH_K,
    query_id: str = "query_id",
    id_column: str = "post_id",
    vector_column: str = "embedding",
    columns: Sequence[str] = (),
    queries_per_cell: int = QUERIES_PER_CELL,
) -> DataFrame:
    """The ``k`` nearest vectors of every query: query id, id, similarity, rank, ``columns``.

    Queries are written out once. Up to about ``queries_per_cell`` of them are one block: vectors are shuffled into slices, as
    many as the shuffle is wide, and each task holds the block and lets its slice's vectors stream by. More queries
    are cut by hash into blocks, and vectors are written once, packed; a task is one block and one part of that table, which it reads
    from the files, so no vector is shuffled however many blocks there are. There are as many blocks as the shuffle is wide at most, or more
    where one would hold over ``QUERIES_PER_TASK`` queries. A task keeps ``k`` ids a query, so the pairs themselves
    are never emitted, and blocks times parts is about the shuffle width or the number of blocks, which bounds what is ranked at
    the end. Nothing but the number of queries comes to the driver.

    Further ``columns`` are looked up afterwards, for the ids found only; by broadcast where the
    written result is small enough for the session.
    """
    asked = staged(queries.select(query_id, vector_column).filter(F.col(vector_column).isNotNull()), "queries")
    width, n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), asked.count()
    blocks = min(math.ceil(n / queries_per_cell), max(width, math.ceil(n / max(queries_per_cell, QUERIES_PER_TASK))))
    wanted = asked.select(F.col(query_id).alias("query"), F.col(vector_column).alias("target"))
    pool = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"))
    if blocks > 1:
        found = _best_per_pair(wanted, pool, k, blocks, math.ceil(width / blocks), queries_per_cell)
    else:
        found = _best_per_slice(wanted, pool, k, width)
    found = found.withColumnsRenamed({"query": query_id, "id": id_column})
    found = top_n_per_group(found, [query_id], [F.desc("similarity"), F.asc(id_column)], k)
    if not columns:
        return found
    return vectors.select(id_column, *columns).join(staged(found, "found"), id_column).select(*found.columns, *columns)


def search_batch(
    vectors: DataFrame,
    queries: DataFrame,
    n_results: int = settings.SEARCH_K,
    subreddit_filter: str | None = None,
) -> DataFrame:
    """``search`` for many queries at once: query_id and the columns of a single search."""
    pool = in_group(vectors, subreddit_filter)
    found = nearest_batch(pool, queries, n_results, columns=["document", "subreddit", "title"])
    return found.withColumnRenamed("document", "content").withColumn("distance", 1 - F.col("similarity"))


def search_texts(
    vectors: DataFrame,
    queries: DataFrame,
    n_results: int = settings.SEARCH_K,
    subreddit_filter: str | None = None,
    encoder: EncoderFactory | None = None,
) -> DataFrame:
    """``search_text`` for many texts: ``queries`` has query_id and text, encoded on the executors."""
    embed = encode_with(encoder or hashing_encoder())
    return search_batch(vectors, queries.select("query_id", embed(F.col("text")).alias("embedding")), n_results, subreddit_filter)


class _Rows(NamedTuple):
    """Vectors by id: as they are, their lengths, and their directions in single precision."""

    ids: pa.Array
    rows: np.ndarray
    lengths: np.ndarray
    short: np.ndarray

    @classmethod
    def of(cls, vectors: pa.RecordBatch, dimension: int) -> "_Rows":
        vectors = vectors.take(pc.sort_indices(vectors["id"]))
        rows, lengths = rows_and_lengths(vectors["vector"], dimension)
        return cls(vectors["id"], rows, lengths, (rows / lengths[:, None]).astype(np.float32))

    def part(self, start: int, length: int) -> "_Rows":
        return _Rows(self.ids.slice(start, length), *(a[start : start + length] for a in self[1:]))


class _Best:
    """The best ``k`` ids of each of some queries, of all vectors added so far."""

    def __init__(self, queries: pa.Table, k: int):
        self.ids, self.k = queries["query"].combine_chunks(), k
        self.matrix = np.array([unit(v) for v in queries["target"].to_pylist()])
        self.kept, self.bar = None, np.full(len(self.matrix), -np.inf)
        # A product of unit vectors in single precision is less than this away from the one in double precision.
        self.short, self.slack = self.matrix.astype(np.float32), (self.matrix.shape[1] + 8) * 2.0**-22

    def add(self, vectors: pa.RecordBatch) -> None:
        self.add_rows(_Rows.of(vectors, self.matrix.shape[1]))

    def add_rows(self, rows: "_Rows") -> None:
        step = max(self.k, CELLS_AT_A_TIME // len(self.matrix))
        for start in range(0, len(rows.ids), step):
            self._add_block(rows.part(start, step))

    def _add_block(self, block: "_Rows") -> None:
        row, query, scores = self._near_the_bar(block)
        if not len(row):
            return
        fresh = pa.table({"query": query, "id": block.ids.take(pa.array(row)), "similarity": rounded(scores)})
        both = fresh if self.kept is None else pa.concat_tables([self.kept, fresh])
        ordered = both.sort_by([("query", "ascending"), ("similarity", "descending"), ("id", "ascending")])
        query = ordered["query"].to_numpy()
        place = np.arange(len(query)) - np.searchsorted(query, query)
        last = place == self.k - 1
        self.bar[query[last]] = ordered["similarity"].to_numpy()[last]
        self.kept = ordered.filter(pa.array(place < self.k))

    def _near_the_bar(self, block: "_Rows") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, queries and similarities of the pairs that may be among the best.

        Once the bars are up, products in single precision leave few pairs, whose similarities are then computed in double.
        """
        if np.isfinite(self.bar).any():
            near = block.short @ self.short.T >= (self.bar - 10.0**-DIGITS - self.slack).astype(np.float32)
            if np.count_nonzero(near) <= 4 * self.k * len(self.matrix):
                row, query = np.divmod(np.flatnonzero(near), len(self.matrix))
                scores = np.einsum("ij,ij->i", block.rows[row], self.matrix[query]) / block.lengths[row]
                near = scores >= self.bar[query] - 10.0**-DIGITS
                return row[near], query[near], scores[near]
        scores = block.rows @ self.matrix.T / block.lengths[:, None]
        row, query = np.nonzero(self._may_be_best(scores))
        return row, query, scores[row, query]

    def _may_be_best(self, scores: np.ndarray) -> np.ndarray:
        """Which scores may still be among the first k; equal ones stay in, for the id to decide."""
        candidates = scores >= self.bar - 10.0**-DIGITS
        if np.count_nonzero(candidates) <= 4 * self.k * len(self.matrix):
            return candidates
        # At first, or among many copies of one vector: raise the bar to the block's own k-th
        # score, and of the scores level with it keep the k lowest ids.
        scores, bar = np.where(np.isnan(scores), -np.inf, rounded(scores)), self.bar
        if len(scores) > self.k:
            bar = np.maximum(bar, np.partition(scores, -self.k, axis=0)[-self.k])
        level = scores == bar
        level &= np.cumsum(level, axis=0) <= self.k
        return ((scores > bar) | level) & np.isfinite(scores)

    def batches(self) -> list[pa.RecordBatch]:
        if self.kept is None:
            return []
        named = {"query": self.ids.take(self.kept["query"]), "id": self.kept["id"], "similarity": self.kept["similarity"]}
        return pa.table(named).to_batches()


def _found(query: StructField, id_: StructField) -> StructType:
    return StructType([query, id_, StructField("similarity", DoubleType())])


def _best_per_slice(wanted: DataFrame, pool: DataFrame, k: int, slices: int) -> DataFrame:
    """The best ``k`` ids of each query within each slice of the vectors; all queries go to each."""
    slice_ = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    # With the vector itself in the hash, rows that share an id are spread as well.
    part = F.pmod(F.xxhash64("id", "vector"), F.lit(slices)).cast("int")
    both = wanted.withColumn("cell", slice_).unionByName(pool.withColumn("cell", part), allowMissingColumns=True)
    both = both.select("cell", F.col("target").isNull().alias("is_vector"), "query", "target", "id", "vector")
    return _best_per_cell(both.repartitionById(slices, F.col("cell")).sortWithinPartitions("cell", "is_vector"), k)


def _packed(rows: DataFrame, name: str) -> DataFrame:
    """Rows in arrays of about ``PACK_BYTES``, each with a number that no other one of its partition has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count()
        for batch in batches:
            step = max(1, len(batch) * PACK_BYTES // max(1, batch.nbytes))
            for start in range(0, len(batch), step):
                part = batch.slice(start, step).to_struct_array()
                yield pa.record_batch({f"{name}_no": pa.array([next(number)]), name: pa.ListArray.from_arrays([0, len(part)], part)})

    kind = ArrayType(rows.schema)
    return rows.mapInArrow(run, StructType([StructField(f"{name}_no", LongType()), StructField(name, kind)]))


def _best_per_pair(wanted: DataFrame, pool: DataFrame, k: int, blocks: int, parts: int, at_once: int) -> DataFrame:
    """The best ``k`` ids of each query within each of ``parts`` parts of the vectors; a task is a block of queries and a part.

    The Cartesian product of partitions holds those on its right and reads those on its left as a stream, so the vectors,
    written once, are read again from their files for each block.
    """
    path = scratch_path(pool.sparkSession, "packs")
    packs = _packed(pool.filter("vector is not null"), "vectors")
    packs.write.option("parquet.block.size", PACK_GROUP_BYTES).parquet(path)
    stored = pool.sparkSession.read.schema(packs.schema).parquet(path).select("vectors").coalesce(parts)
    # With the vector itself in the hash, rows that share an id are spread as well.
    block = F.pmod(F.xxhash64("query", "target"), F.lit(blocks)).cast("int")
    asked = _packed(wanted.repartitionById(blocks, block), "queries")
    pairs = stored.crossJoin(asked.hint("shuffle_replicate_nl"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[_Best]] = {}
        for batch in batches:
            for i, number in enumerate(batch["queries_no"].to_pylist()):
                if number not in best:
                    queries = pa.Table.from_struct_array(batch["queries"].slice(i, 1).flatten())
                    best[number] = [_Best(queries.slice(start, at_once), k) for start in range(0, len(queries), at_once)]
                vectors = pa.RecordBatch.from_struct_array(batch["vectors"].slice(i, 1).flatten())
                rows = {d: _Rows.of(vectors, d) for d in {some.matrix.shape[1] for some in best[number]}}
                for some in best[number]:
                    some.add_rows(rows[some.matrix.shape[1]])
        for some in itertools.chain.from_iterable(best.values()):
            yield from some.batches()

    return pairs.mapInArrow(run, _found(wanted.schema["query"], pool.schema["id"]))


def _best_per_cell(cells: DataFrame, k: int) -> DataFrame:
    """The best ``k`` ids of each query within each cell; a cell's queries come before its vectors."""

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
        """Rows of one cell and kind."""
        cell, kind = (batch[c].to_numpy(zero_copy_only=False) for c in ("cell", "is_vector"))
        ends = np.flatnonzero((np.diff(cell) != 0) | (kind[1:] != kind[:-1])) + 1
        for start, stop in itertools.pairwise([0, *ends.tolist(), len(batch)]):
            if stop > start:
                yield int(cell[start]), bool(kind[start]), batch.slice(start, stop - start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, queries, best = None, [], None
        for batch in batches:
            for cell, is_vector, rows in runs(batch):
                if cell != at:
                    if best is not None:
                        yield from best.batches()
                    at, queries, best = cell, [], None
                if not is_vector:
                    queries.append(rows.select(["query", "target"]))
                elif queries:
                    best = best or _Best(pa.Table.from_batches(queries), k)
                    best.add(rows)
        if best is not None:
            yield from best.batches()

    return cells.mapInArrow(run, _found(cells.schema["query"], cells.schema["id"]))


def bucket_planes(bits: int, dimension: int) -> np.ndarray:
    """``bits`` fixed planes with coefficients +1 and -1, by the parity of an md5 digit."""
    digit = [[hashlib.md5(f"{b}:{d}".encode()).hexdigest()[0] for d in range(dimension)] for b in range(bits)]
    return np.array([[1 if int(x, 16) % 2 == 0 else -1 for x in row] for row in digit], dtype=np.float64)


def with_bucket(vectors: DataFrame, bits: int, dimension: int, vector_column: str = "embedding") -> DataFrame:
    """Add ``bucket``: the sides of ``bits`` planes (sign random projection for cosine).

    Store the table partitioned by it, so that ``nearest_in_buckets`` reads few folders.
    """
    bucket = side_bits_of(bucket_planes(bits, dimension))
    return vectors.withColumn("bucket", bucket(F.col(vector_column)))


def enough_sides(bits: int) -> int:
    """The radius of a search by default: the least that found 0.9 of the exact results in the test embeddings, for 2 to 8 bits."""
    return bits // 2 + 1


def in_buckets(bucketed: DataFrame, query: Sequence[float], bits: int, radius: int | None = None) -> DataFrame:
    """Rows of the buckets at most ``radius`` sides away from the query's own, or ``enough_sides``."""
    sides = bucket_planes(bits, len(query)) @ unit(query) >= 0
    home = sum(1 << i for i, side in enumerate(sides) if side)
    radius = enough_sides(bits) if radius is None else radius
    return bucketed.filter(F.bit_count(F.col("bucket").bitwiseXOR(F.lit(home))) <= radius)


def nearest_in_buckets(
    bucketed: DataFrame,
    query: Sequence[float],
    bits: int,
    radius: int | None = None,
    k: int = settings.SEARCH_K,
    id_column: str = "post_id",
) -> DataFrame:
    """Approximate ``nearest``: rank only the buckets at most ``radius`` sides away.

    The bucket test prunes partitions; within them the ranking is exact, and with
    ``radius = bits`` so is the whole search. Without a radius it is ``enough_sides(bits)``.
    """
    return nearest(in_buckets(bucketed, query, bits, radius), query, k, id_column).drop("bucket")
