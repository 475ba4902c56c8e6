"""Benchmark decontamination by spaced seeds.

A seed is a window of words of which a fixed mask keeps some and ignores others, so a
replaced word at an ignored position leaves the seed as it is. Seeds of the test items meet seeds of
the documents by a join on their hash; around each hit the two texts are aligned and the overlap is
verified word by word, with replaced words allowed.

Words are runs of letters and digits, lower-cased. An overlap is the stretch of an alignment with the most equal words of
which they make up ``MIN_SHARE``; it counts from ``MIN_WORDS`` equal words on, or ``MIN_SHARE`` of the words of a shorter item.
Every overlap has a seed: any 12 words with 2 replaced, 15 or 16 with 3 and 20 with 4 hold one by ``MASKS``, and a longer stretch
holds one of these. Items of fewer words than ``SPAN`` have masks by their length. Items without words are never found.
Items of fewer than ``CERTAIN_WORDS`` words occur in clean texts as well: their overlaps are reported as not ``certain``, and
``contaminated`` leaves documents alone that hold no others.

A Bloom filter sized by the number of test seeds (32 MB at most) goes to all tasks, so that of a document only the
stretches around probable hits leave the scan; whatever it lets through is checked by the join. The test
seeds are replicated ``SALTS`` times, so that a passage which a third of all documents hold is not one task's work.

Where a stretch repeats itself, of the hits whose surroundings are equal as far as the longest item reaches only the first is kept:
the others would give the same alignments again. An alignment carries only the words that face its item.

Defined results: null and empty texts, and an empty benchmark, give no rows; repeated documents give the
same row once; a document without id is reported under null. Very long texts are read whole, in chunks that overlap.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import CHUNK_BYTES, flat_bytes, mixed, slices, span_hashes, spread_join, staged, with_fields

# Fixed masks: positions that count, the first and last of a window among them.
MASKS = ((0, 1, 3, 4, 5, 6), (0, 1, 3, 7, 9, 10), (0, 1, 2, 4, 5, 9), (0, 2, 3, 5, 6, 8))
# For items of fewer words, by their number; up to 4 words none may be replaced.
SHORT_MASKS = {
    **{n: (tuple(range(n)),) for n in range(1, 5)},
    5: ((0, 2, 3), (0, 2, 4)),
    6: ((0, 1, 2, 4), (0, 3, 4, 5)),
    7: ((0, 1, 3, 4),),
    8: ((0, 1, 3, 4, 5), (0, 1, 3, 5, 6)),
    9: ((0, 1, 2, 4, 5, 6), (0, 1, 2, 3, 4, 5)),
    10: ((0, 1, 3, 4, 5), (0, 1, 4, 6, 7), (0, 1, 2, 3, 4)),
    11: ((0, 1, 2, 4, 5, 6), (0, 1, 2, 4, 7, 8), (0, 3, 4, 5, 6, 7), (0, 1, 2, 3, 4, 5)),
}
SPAN = 12
MIN_WORDS = 13
MIN_SHARE = 0.8
# The share as whole numbers: for each replaced word four equal ones.
SHARE_STEPS = (1, 4)
# Words of a document kept on either side of a hit, for the alignment.
AROUND = 96
# Of items with fewer words an overlap proves nothing.
CERTAIN_WORDS = 8
# The filter has 32 bits per seed, from 2**LEAST_BITS to 2**MOST_BITS in all; a full one lets more pass, never less.
LEAST_BITS, MOST_BITS = 24, 28
# Bits set per seed; at 32 bits per seed some 25 of a million others pass.
PLACES = 6
SALTS = 16

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and words per text."""
    data, offsets = flat_bytes(pc.utf8_lower(pc.fill_null(texts, "")))
    inside = _WORD_BYTE[data]
    opens, closes = inside.copy(), inside.copy()
    begins = offsets[:-1][np.diff(offsets) > 0]
    # A word ends with its text.
    opens[1:] &= ~inside[:-1]
    opens[begins] = inside[begins]
    closes[:-1] &= ~inside[1:]
    closes[begins[1:] - 1] = inside[begins[1:] - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    counts = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    return span_hashes(data, starts, ends), counts


def seeds_of(words: np.ndarray, lengths: list[int]) -> Iterator[np.ndarray]:
    """The seeds at every position of ``words``, by each mask for items of these lengths; ``SPAN`` is for it and more."""
    for length in lengths:
        for number, mask in enumerate(SHORT_MASKS.get(length, MASKS), 1):
            total = max(0, len(words) - mask[-1])
            seed = np.full(total, 1000 * length + number, np.uint64)
            for place in mask:
                seed = seed * np.uint64(0x9E3779B97F4A7C15) + words[place : place + total]
            yield mixed(seed)


def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", CHUNK_BYTES):
            hashes, counts = word_hashes(part["text"])
            ends = np.cumsum(counts)
            for row, (end, n) in enumerate(zip(ends, counts, strict=True)):
                words = hashes[end - n : end]
                if not n:
                    continue
                found = list(seeds_of(words, [min(int(n), SPAN)]))
                seeds, places = np.concatenate(found), np.concatenate([np.arange(len(s)) for s in found])
                yield pa.RecordBatch.from_pydict(
                    {
                        "item_id": part["item_id"].take(pa.array([row])),
                        "words": pa.array([words.astype(np.int64)], pa.list_(pa.int64())),
                        "seeds": pa.array([seeds.astype(np.int64)], pa.list_(pa.int64())),
                        "places": pa.array([places.astype(np.int32)], pa.list_(pa.int32())),
                    }
                )


class Bloom:
    """A filter of ``PLACES`` bits per seed, in even steps from one another; the number of bits is a power of two."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.mask = np.uint64(len(bits) * 8 - 1)

    def maybe(self, seeds: np.ndarray) -> np.ndarray:
        """Positions of seeds that may be among the test seeds."""
        place = seeds & self.mask
        kept = np.flatnonzero(self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
        # Few are left after the first place.
        for number in range(1, PLACES):
            some = seeds[kept]
            step = (some >> np.uint64(32)) & self.mask | np.uint64(1)
            place = ((some & self.mask) + np.uint64(number) * step) & self.mask
            kept = kept[(self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1) > 0]
        return kept


def _bloom(items: DataFrame, n_seeds: int) -> Bloom:
    size = 1 << min(MOST_BITS, max(LEAST_BITS, (32 * n_seeds).bit_length()))
    seed, mask = F.col("seed"), F.lit(size - 1)
    step = F.shiftrightunsigned(seed, 32).bitwiseAND(mask).bitwiseOR(F.lit(1))
    places = [(seed.bitwiseAND(mask) + number * step).bitwiseAND(mask) for number in range(PLACES)]
    both = items.select(F.explode("seeds").alias("seed")).select(F.explode(F.array(*places)).alias("bit"))
    # The filter itself is what comes back, in words of 32 bits.
    words = both.select((F.col("bit") / 32).cast("int").alias("at"), F.expr("shiftleft(1L, int(bit % 32))").alias("set"))
    found = words.groupBy("at").agg(F.bit_or("set").alias("set")).toArrow()
    bits = np.zeros(size // 32, "<u4")
    bits[found["at"].to_numpy()] = found["set"].to_numpy().astype(np.uint32)
    return Bloom(bits.view(np.uint8))


def _ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def contexts(words: np.ndarray, reach: int) -> np.ndarray:
    """A number for each place: equal where the ``reach`` words before it and from it on are equal, borders included."""
    n = len(words)
    ranks = _ranks(words)
    border = np.full(reach, n, np.int64)
    ranks = np.concatenate([border, ranks, border])
    # Numbers for windows of one word, then of two, four and so on, each from two shorter ones.
    width = 1
    while width < 2 * reach:
        step = min(width, 2 * reach - width)
        ranks = _ranks(ranks[:-step] * (ranks.max() + 1) + ranks[step:])
        width += step
    return ranks[:n]


def _first_of_equals(words: np.ndarray, at: np.ndarray, seeds: np.ndarray, reach: int) -> np.ndarray:
    """Which hits (places ``at`` in a stretch, and seeds) to keep: the first of those with equal surroundings."""
    numbers = _ranks(seeds)
    # With a border in sight of every place no two are equal.
    if reach >= len(words) or numbers.max() + 1 == len(numbers):
        return np.arange(len(at))
    where = contexts(words, reach)[at]
    return np.sort(np.unique(where * (numbers.max() + 1) + numbers, return_index=True)[1])


def _stretches(words: np.ndarray, bloom: Bloom, lengths: list[int], reach: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(start, end, hit positions, hit seeds) of each stretch of words around probable hits."""
    places, seeds = [], []
    for some in seeds_of(words, lengths):
        at = bloom.maybe(some)
        places.append(at)
        seeds.append(some[at])
    if not sum(map(len, places)):
        return
    places, seeds = np.concatenate(places), np.concatenate(seeds)
    order = np.argsort(places, kind="stable")
    places, seeds = places[order], seeds[order]
    cuts = np.flatnonzero(np.diff(places) > AROUND) + 1
    for at, values in zip(np.split(places, cuts), np.split(seeds, cuts), strict=True):
        start, end = max(0, int(at[0]) - AROUND), min(len(words), int(at[-1]) + SPAN + AROUND)
        kept = _first_of_equals(words[start:end], at - start, values, reach)
        yield start, end, at[kept], values[kept]


def _aligned(equal: np.ndarray, item_words: int) -> tuple[int, int, int] | None:
    """Best stretch of one alignment, told by which of its words are equal: (first word, words, equal words)."""
    # A stretch has the share where its steps do not sum below 0; the longest to each end has the most equal words.
    steps = np.concatenate([[0], np.cumsum(np.where(equal, SHARE_STEPS[0], -SHARE_STEPS[1]))])
    count = np.concatenate([[0], np.cumsum(equal)])
    begins = np.searchsorted(-np.minimum.accumulate(steps), -steps)
    end = int(np.argmax(count - count[begins]))
    begin = int(begins[end])
    same = int(count[end] - count[begin])
    if not same or same < min(MIN_WORDS, -(-item_words * SHARE_STEPS[1] // sum(SHARE_STEPS))):
        return None
    begin += int(np.argmax(equal[begin:end]))
    return begin, end - begin, same


def overlaps(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Pairs of a document and a test item it holds words of: ids, ``doc_start`` (in words), ``n_words``, ``n_equal``, ``certain``.

    One row per pair, of its overlap with the most equal words (then the first).
    """
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    items = benchmark.select("item_id", "text").distinct()
    items = staged(
        items.mapInArrow(item_seeds, with_fields(items, ["item_id"], "words array<long>, seeds array<long>, places array<int>"))
        .withColumn("item", F.xxhash64("item_id", "words")),
        "items",
    )
    # At most SPAN lengths.
    sizes = items.groupBy(F.least(F.size("words"), F.lit(SPAN))).agg(F.max(F.size("words")), F.sum(F.size("seeds"))).collect()
    lengths = [r[0] for r in sizes]
    reach = max([SPAN, *(r[1] for r in sizes)])
    shared = docs.sparkSession.sparkContext.broadcast(_bloom(items, sum(r[2] for r in sizes)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, counts = word_hashes(part["text"])
                ends = np.cumsum(counts)
                rows, starts, words, places, seeds = [], [], [], [], []
                for row in np.flatnonzero(counts > 0):
                    own = hashes[ends[row] - counts[row] : ends[row]]
                    for start, end, at, values in _stretches(own, bloom, lengths, reach):
                        rows.append(row)
                        starts.append(start)
                        words.append(own[start:end].astype(np.int64))
                        places.append(at.astype(np.int64))
                        seeds.append(values.astype(np.int64))
                if rows:
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": part["doc_id"].take(pa.array(rows)),
                            "start": pa.array(starts, pa.int64()),
                            "words": pa.array(words, pa.list_(pa.int64())),
                            "places": pa.array(places, pa.list_(pa.int64())),
                            "seeds": pa.array(seeds, pa.list_(pa.int64())),
                        }
                    )

    stretches = docs.mapInArrow(
        scan, with_fields(docs, ["doc_id"], "start long, words array<long>, places array<long>, seeds array<long>")
    )
    stretches = staged(stretches.withColumn("stretch", F.monotonically_increasing_id()), "stretches")
    hits = stretches.select("stretch", F.explode(F.arrays_zip("places", "seeds")).alias("hit")).select(
        "stretch", F.col("hit.places").alias("place"), F.col("hit.seeds").alias("seed")
    )
    hits = hits.withColumn("salt", F.pmod(F.xxhash64("stretch", "place"), F.lit(SALTS)).cast("int"))
    tests = items.select("item", F.explode(F.arrays_zip("seeds", "places")).alias("one")).select(
        "item",
        F.col("one.seeds").alias("seed"),
        F.col("one.places").alias("item_place"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    alignments = (
        hits.join(tests, ["seed", "salt"])
        .select("stretch", "item", (F.col("place") - F.col("item_place")).alias("diagonal"))
        .distinct()
    )
    alignments = staged(alignments, "alignments")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            equal = batch["words"].flatten().to_numpy() == batch["item_words"].flatten().to_numpy()
            ends = np.cumsum(pc.list_value_length(batch["words"]).to_numpy())
            first, size = batch["first"].to_numpy(), batch["size"].to_numpy()
            rows, found = [], []
            for row, own in enumerate(np.split(equal, ends[:-1])):
                best = _aligned(own, int(size[row]))
                if best:
                    rows.append(row)
                    found.append((first[row] + best[0], *best[1:], size[row] >= CERTAIN_WORDS))
            values = np.array(found, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(rows, pa.int64())), batch["item_id"].take(pa.array(rows, pa.int64())),
                 *(pa.array(values[:, i]) for i in range(3)), pa.array(values[:, 3] > 0)],
                ["doc_id", "item_id", "doc_start", "n_words", "n_equal", "certain"],
            )

    asked = items.join(alignments.groupBy("item").agg(F.count("*").alias("rows")), "item")
    asked = asked.select("item", "item_id", F.col("words").alias("item_words"), "rows")
    # The words that face each other: from one place in the stretch and one in the item on.
    low = F.greatest(F.col("diagonal") - F.col("start"), F.lit(0)).cast("int")
    item_low = F.greatest(F.col("start") - F.col("diagonal"), F.lit(0)).cast("int")
    facing = F.least(F.size("words") - low, F.size("item_words") - item_low)
    aligned = (
        spread_join(alignments, asked, "item", "rows", "stretch")
        .join(stretches.select("stretch", "doc_id", "start", "words"), "stretch")
        .select(
            "doc_id", "item_id", (F.col("start") + low).alias("first"), F.size("item_words").alias("size"),
            F.slice("words", low + 1, facing).alias("words"), F.slice("item_words", item_low + 1, facing).alias("item_words"),
        )
    )
    fields = with_fields(aligned, ["doc_id", "item_id"], "doc_start long, n_words long, n_equal long, certain boolean")
    best = F.max(F.struct("n_equal", (-F.col("doc_start")).alias("late"), "n_words")).alias("best")
    found = aligned.mapInArrow(verify, fields).groupBy("doc_id", "item_id").agg(best, F.max("certain").alias("certain"))
    return found.select("doc_id", "item_id", (-F.col("best.late")).alias("doc_start"), "best.n_words", "best.n_equal", "certain")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Ids of the documents that hold a passage of the benchmark for certain, once each, as ``doc_id``."""
    return overlaps(docs, benchmark, id_column=id_column).filter("certain").select("doc_id").distinct()
