"""Near-duplicates by Jaccard similarity of word shingles, with SetSketch registers.

A sketch has ``REGISTERS`` registers. Every element of a set is a Poisson process of points, each of which falls on a register
by chance; a register keeps the smallest value it has seen, truncated to a whole power of ``BASE``. So a register is the
logarithm of an exponential minimum: the registers of a union are the maxima of the registers, copies change nothing, and two
sets agree in a register with about their Jaccard similarity as probability. Points are drawn in rising order, and an element
stops at the largest of its set's registers, so a set of n elements costs about n + m log m points, not n times m.

1. Texts become sets of hashed shingles and sketches; sets that are equal meet, and one of each goes on.
2. Bands of ``ROWS`` registers each are hashed. Sets that share a band are compared in cells of bounded size: sizes first, then how often either
   register is larger. A pair stays if the likelihood of its three counts, both set sizes known, does not rule the threshold out. A
   cell sends a spanning forest of what stays, never all pairs.
3. The components of these forests are compared on full sets, again in cells of bounded size, through an inverted index
   of their shingles. What is sent are the links that join something new.

Nothing is capped: crowded bands and components are cut into parts, and every pair of parts is a cell. A pair at a
similarity of 0.85 escapes all bands with probability 6e-11, and the likelihood with at most 2e-9.

Defined results: null, empty and wordless texts have no shingle and are linked with nothing. Fewer words than a shingle are one
shingle. Repeated rows each come back. A row without id takes part; a component's id is the smallest id it has (null if none), and
``kept`` compares null as a value. Shingles are told apart by 64-bit hashes. Other columns are passed over.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import components, encoded_words, may_be_among, mixed, slices, spread_join, staged

SHINGLE = 5
PERCENT = 85
REGISTERS = 128  # a power of two
ROWS = 4
BASE = 1.001
RATE = 20.0
TOP = 65_535
# How much less likely the threshold may be than the best fit, as a logarithm.
SLACK = 20.0
# Sketches of one part of a band, and shingles of one part of a component.
BAND_PART = 2048
SET_PART = 1_000_000
# Most rows of a cell that are tried as its hub.
HUBS = 8
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of all distinct shingles of each text, sorted by both."""
    codes, distinct, n_words = encoded_words(texts)
    word = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()], np.uint64)[codes]
    rows = np.repeat(np.arange(len(texts)), n_words)
    # A shingle starts at each word that has enough words after it, or at the first of too few.
    place = np.arange(len(rows)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
    length = np.minimum(n_words, shingle)[rows]
    starts = np.flatnonzero(place <= n_words[rows] - length)
    hashes = length[starts].astype(np.uint64)
    for i in range(shingle):
        more = i < length[starts]
        at = starts[more] + i
        hashes[more] = mixed(hashes[more] * _GOLDEN + word[at])
    rows = rows[starts]
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[fresh], hashes[fresh]


def registers(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """The sketches of ``n`` sets, given as sorted rows and hashes; a set without elements has zeros."""
    least = np.full(n * REGISTERS, np.inf)
    x, tick = np.zeros(len(rows)), 0
    while len(rows):
        # Many points at a time where few elements are left.
        width = int(np.clip(8192 // len(rows), 1, 64))
        ticks = (np.arange(tick, tick + width, dtype=np.uint64) + np.uint64(1)) * _GOLDEN
        drawn = mixed(hashes[:, None] + ticks[None, :])
        drawn = mixed(drawn ^ _GOLDEN)
        steps = -np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / REGISTERS
        points = x[:, None] + np.cumsum(steps, axis=1)
        at = rows[:, None] * REGISTERS + (drawn & np.uint64(REGISTERS - 1)).astype(np.int64)
        np.minimum.at(least, at.ravel(), points.ravel())
        bound = least.reshape(n, REGISTERS).max(axis=1)
        x, tick = points[:, -1], tick + width
        open_ = x < bound[rows]
        rows, hashes, x = rows[open_], hashes[open_], x[open_]
    with np.errstate(divide="ignore"):
        found = np.floor(1 - np.log(least / RATE) / np.log(BASE))
    return np.clip(np.nan_to_num(found, neginf=0), 0, TOP).astype(np.uint16).reshape(n, REGISTERS)


def set_digests(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """16 bytes that tell sets apart: two sums of scrambled elements."""
    out = np.zeros((n, 2), np.uint64)
    for i, salt in enumerate((0x2545F4914F6CDD1D, 0x94D049BB133111EB)):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(mixed(hashes ^ np.uint64(salt)) + _GOLDEN))])
        ends = np.searchsorted(rows, np.arange(n), side="right")
        starts = np.searchsorted(rows, np.arange(n), side="left")
        out[:, i] = sums[ends] - sums[starts]
    return out


def _binary(values: np.ndarray, mask: np.ndarray | None = None) -> pa.Array:
    """The rows of an array as binary values."""
    width = values.itemsize * values.shape[1]
    fixed = pa.Array.from_buffers(pa.binary(width), len(values), [None, pa.py_buffer(np.ascontiguousarray(values).tobytes())])
    out = fixed.cast(pa.binary())
    return out if mask is None else pc.if_else(pa.array(mask), pa.scalar(None, pa.binary()), out)


def _matrix(values: pa.Array, kind: type) -> np.ndarray:
    """Binary values of one length as the rows of an array."""
    joined = b"".join(values.to_pylist())
    return np.frombuffer(joined, kind).reshape(len(values), -1) if len(values) else np.zeros((0, 1), kind)


def _sketch(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows, hashes = shingle_sets(part["text"], shingle)
                n = np.bincount(rows, minlength=len(part)).astype(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": part["id"],
                        "text_key": part["text_key"],
                        "n": n,
                        "node": _binary(set_digests(rows, hashes, len(part)), n == 0),
                        "registers": _binary(registers(rows, hashes, len(part)), n == 0),
                    }
                )

    return run


def sketches(docs: DataFrame, text_column: str = "text", id_column: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """One row per document: its id, a key of its text, the size of its set ``n``, the set's digest ``node`` and its registers."""
    texts = docs.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text_key"), F.col(text_column).alias("text"))
    made = (F.lit(None).cast(kind).alias(name) for name, kind in (("n", "long"), ("node", "binary"), ("registers", "binary")))
    return texts.mapInArrow(_sketch(shingle), texts.select("id", "text_key", *made).schema)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), 4096):
            part = batch.slice(start, 4096)
            values = _matrix(part["registers"], np.uint16).astype(np.uint64)
            for band in range(REGISTERS // ROWS if len(part) else 0):
                key = np.full(len(values), band + 1, np.uint64)
                for i in range(band * ROWS, (band + 1) * ROWS):
                    key = mixed(key * _GOLDEN + values[:, i])
                yield pa.RecordBatch.from_pydict({"band": key.astype(np.int64), "node": part["node"]})


def _chance(x: np.ndarray) -> np.ndarray:
    """The probability that a register of one set is the larger, ``x`` being the share of the union that it has alone."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def log_likelihood(j: np.ndarray, u: np.ndarray, larger: np.ndarray, smaller: np.ndarray) -> np.ndarray:
    """Of similarity ``j``, given how many registers are larger or smaller; ``u`` is the first set's share in both sizes."""
    v = 1 - u
    more, less = _chance(u - v * j), _chance(v - u * j)
    same = np.maximum(1 - more - less, 1e-300)
    return (
        larger * np.log(np.maximum(more, 1e-300)) + smaller * np.log(np.maximum(less, 1e-300)) + (REGISTERS - larger - smaller) * np.log(same)
    )


def similarity(u: np.ndarray, larger: np.ndarray, smaller: np.ndarray) -> np.ndarray:
    """The similarity of the greatest likelihood, which is concave: thirds of the interval are dropped in turn."""
    low, high = np.zeros(len(u)), np.minimum(u / (1 - u), (1 - u) / u)
    for _ in range(24):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        up = log_likelihood(a, u, larger, smaller) < log_likelihood(b, u, larger, smaller)
        low, high = np.where(up, a, low), np.where(up, high, b)
    return (low + high) / 2


def may_link(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether pairs of sketches with set sizes may reach the threshold; arrays broadcast over all but the last axis."""
    n_a, n_b = np.broadcast_arrays(n_a, n_b)
    out = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    at = np.nonzero(out)
    whole = np.broadcast_shapes(a.shape, b.shape)
    one, two = np.broadcast_to(a, whole)[at], np.broadcast_to(b, whole)[at]
    larger, smaller = np.count_nonzero(one > two, axis=1), np.count_nonzero(one < two, axis=1)
    u = n_a[at] / (n_a[at] + n_b[at])
    best = similarity(u, larger, smaller)
    bar = np.minimum(percent / 100, np.minimum(u / (1 - u), (1 - u) / u))
    behind = log_likelihood(best, u, larger, smaller) - log_likelihood(bar, u, larger, smaller)
    out = np.array(out)
    out[at] = (best >= bar) | (behind <= SLACK)
    return out


class _Forest:
    """What is linked with what, so far."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = int(parent[x])
        return x

    def link(self, x: int, others: np.ndarray) -> list[int]:
        """Links ``x`` with all ``others``; returns those that were not linked before."""
        new = []
        # One look at the roots passes over most of what is linked already.
        for other in others[self.parent[others] != self.root(x)].tolist():
            a, b = self.root(x), self.root(other)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                new.append(other)
        return new


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole runs of rows of one cell, many runs at a time: a table, and where its runs start and end."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        cell = batch["cell"].to_numpy()
        if rest and rest[-1]["cell"][-1].as_py() != cell[0]:
            yield _table(rest)
            rest = []
        last = int(np.flatnonzero(cell[1:] != cell[:-1])[-1]) + 1 if (cell != cell[0]).any() else 0
        if last:
            yield _table([*rest, batch.slice(0, last)])
            rest = []
        rest.append(batch.slice(last))
    if rest:
        yield _table(rest)


def _table(batches: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(batches).combine_chunks()
    cell = table["cell"].to_numpy()
    return table, np.concatenate([[0], 1 + np.flatnonzero(cell[1:] != cell[:-1]), [len(cell)]])


def _edges(nodes: pa.ChunkedArray, pairs: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    if pairs:
        at = np.array(pairs, np.int64)
        found = pa.table({"a": nodes.take(pa.array(at[:, 0])), "b": nodes.take(pa.array(at[:, 1]))})
        yield from found.combine_chunks().to_batches()


def _forest_of(some: np.ndarray, many: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sketches that may link; ``many`` are the set sizes.

    Of some rows, spread over the cell, the one near most others is its hub. What is near the hub is joined by it and is compared
    with what is not, but not with itself; so a tight group costs in proportion to its rows, not to their square.
    """
    size = len(some)
    tries = np.linspace(0, size - 1, min(HUBS, 1 + size // 32)).astype(np.int64)
    near = may_link(some[tries, None], some[None, :], many[tries, None], many[None, :], percent)
    best = int(near.sum(axis=1).argmax())
    hub, joined = int(tries[best]), near[best]
    joined[hub] = False
    rest = np.flatnonzero(~joined)
    joined, rest = np.flatnonzero(joined), rest[rest != hub]
    forest = _Forest(size)
    out = [(hub, other) for other in forest.link(hub, joined)]
    step = max(1, (1 << 22) // (size * REGISTERS))
    for i in range(0, len(rest), step):
        block = rest[i : i + step]
        others = np.concatenate([joined, rest[i:]])
        near = may_link(some[block, None], some[None, others], many[block, None], many[None, others], percent)
        for row, links in zip(block.tolist(), near, strict=True):
            out += [(row, other) for other in forest.link(row, others[links])]
    return out


def _compare_sketches(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, ends in _runs(batches):
            values = _matrix(table["registers"].combine_chunks(), np.uint16)
            n = table["n"].to_numpy()
            sizes = np.diff(ends)
            # Cells of two, which most are, all at once.
            twos = ends[:-1][sizes == 2]
            near = may_link(values[twos], values[twos + 1], n[twos], n[twos + 1], percent)
            pairs = [(i, i + 1) for i in twos[near].tolist()]
            for start, size in zip(ends[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                found = _forest_of(values[start : start + size], n[start : start + size], percent)
                pairs += [(start + a, start + b) for a, b in found]
            yield from _edges(table["node"], pairs)

    return run


def _compare_sets(percent: int) -> Callable:
    def links(sets: pa.Array) -> list[tuple[int, int]]:
        """A spanning forest of all links between the sets of one cell; its hub comes first."""
        n = pc.list_value_length(sets).to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.repeat(np.arange(len(n)), n)
        _, code = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        order = np.argsort(code, kind="stable")
        holders = rows[order]
        starts = np.concatenate([[0], np.cumsum(np.bincount(code))])
        ends = np.cumsum(n)
        forest, out = _Forest(len(n)), []
        for x in range(len(n)):
            # Sets that the hub's component holds already are met by all others.
            if x and forest.root(x) == forest.root(0):
                continue
            mine = code[ends[x] - n[x] : ends[x]]
            many = starts[mine + 1] - starts[mine]
            at = np.repeat(starts[mine] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            shared = np.bincount(holders[at], minlength=len(n))
            near = np.flatnonzero(100 * shared >= percent * (n[x] + n - shared))
            out += [(x, other) for other in forest.link(x, near)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, ends in _runs(batches):
            sets, pairs = table["set"].combine_chunks(), []
            for start, stop in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                if stop > start + 1:
                    pairs += [(start + a, start + b) for a, b in links(sets.slice(start, stop - start))]
            yield from _edges(table["node"], pairs)

    return run


def _cells(rows: DataFrame, key: str, everywhere=None) -> DataFrame:
    """Rows of one ``key``, cut into ``parts`` by node, in every pair of parts; those ``everywhere`` in all cells.

    A cell is a hash: two that meet in one are compared together, which does no harm.
    """
    own, other = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"), F.col("other")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = dealt.withColumn("cell", F.xxhash64(key, F.least("own", other), F.greatest("own", other)))
    if everywhere is not None:
        all_parts = F.sequence(F.lit(0), F.col("parts") - 1)
        hubs = rows.filter(everywhere).withColumn("own", F.explode(all_parts)).withColumn("other", F.explode(all_parts))
        hubs = hubs.filter("own <= other").withColumn("cell", F.xxhash64(key, "own", "other"))
        cells = cells.filter(~everywhere).unionByName(hubs)
    return cells.drop("own", "other", "parts")


def _sets(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows, hashes = shingle_sets(part["text"], shingle)
                offsets = np.searchsorted(rows, np.arange(len(part) + 1)).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.astype(np.int64)))
                yield pa.RecordBatch.from_pydict({"node": _binary(set_digests(rows, hashes, len(part))), "set": sets})

    return run


def candidates(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) between sets whose sketches may link them, as spanning forests; ``sets`` has node, n and registers."""
    bands = sets.select("node", "registers").mapInArrow(_bands, "band long, node binary")
    crowded = bands.groupBy("band").agg(F.count("*").alias("rows")).filter("rows > 1")
    crowded = staged(crowded.withColumn("parts", F.ceil(F.col("rows") / BAND_PART).cast("int")), "bands")
    met = spread_join(bands, crowded, "band", "rows", "node").join(sets.select("node", "n", "registers"), "node")
    cells = _cells(met, "band").select("cell", "node", "n", "registers")
    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(_compare_sketches(percent), "a binary, b binary").distinct()


def links(docs: DataFrame, sets: DataFrame, groups: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """Edges (a, b) that connect the sets of each of ``groups`` (node, root) as all links do.

    Texts are read again for the sets in groups only; ``docs`` has text and text_key.
    """
    wanted = staged(groups.join(sets.select("node", "n", "least", "text_key"), "node"), "wanted")
    first = F.min(F.struct(F.col("least").isNull(), "least", "node"))["node"]
    sizes = wanted.groupBy("root").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"), first.alias("hub"))
    parts = F.ceil(F.col("shingles") / SET_PART).cast("int").alias("parts")
    placed = spread_join(wanted, staged(sizes.select("root", "rows", "hub", parts), "groups"), "root", "rows", "node")
    # Few texts are wanted; a bitmap keeps most of the others from being moved to the join.
    keys = wanted.select("text_key")
    some = docs.filter(may_be_among(keys, "text_key")("text_key"))
    texts = some.join(keys.distinct(), "text_key", "left_semi").groupBy("text_key").agg(F.any_value("text").alias("text"))
    full = texts.select("text").mapInArrow(_sets(shingle), "node binary, set array<long>")
    cells = _cells(placed.select("root", "node", "hub", "parts"), "root", F.col("node") == F.col("hub"))
    rows = cells.join(full.dropDuplicates(["node"]), "node").select("cell", (F.col("node") != F.col("hub")).alias("late"), "node", "set")
    ordered = rows.repartition("cell").sortWithinPartitions("cell", "late")
    return ordered.mapInArrow(_compare_sets(percent), "a binary, b binary").distinct()


def near_duplicates(
    docs: DataFrame, text_column: str = "text", id_column: str = "doc_id", percent: int = PERCENT, shingle: int = SHINGLE
) -> DataFrame:
    """One row per document: its id, ``n_shingles``, ``component_id`` and ``kept``."""
    rows = staged(sketches(docs, text_column, id_column, shingle), "sketches")
    equal = rows.filter("node is not null").groupBy("node").agg(
        F.min("id").alias("least"),
        F.count("*").alias("rows"),
        F.max("n").alias("n"),
        F.any_value("text_key").alias("text_key"),
        F.any_value("registers").alias("registers"),
    )
    sets = staged(equal, "sets")
    texts = docs.select(F.xxhash64(text_column).alias("text_key"), F.col(text_column).alias("text"))
    groups = components(candidates(sets, percent))
    roots = staged(components(links(texts, sets, groups, percent, shingle)), "roots")
    linked = staged(roots.join(sets.select("node", "least"), "node"), "linked")
    least = staged(linked.groupBy("root").agg(F.min("least").alias("of_links"), F.count("*").alias("rows")), "least")
    named = spread_join(linked.select("root", "node"), least, "root", "rows", "node").select("node", F.struct("of_links").alias("of_links"))
    # A component without any id has none, though its sets are linked.
    own = F.when(F.col("of_links").isNull(), F.col("least")).otherwise(F.col("of_links.of_links"))
    classes = staged(sets.select("node", "least", "rows").join(named, "node", "left").select("node", "rows", own.alias("component_id")), "classes")
    found = spread_join(rows.filter("node is not null").select("id", "n", "node"), classes, "node", "rows", "id")
    alone = rows.filter("node is null").select("id", "n", F.col("id").alias("component_id"))
    return found.select("id", "n", "component_id").unionAll(alone).select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
