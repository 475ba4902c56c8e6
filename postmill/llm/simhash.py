"""SimHash near-duplicates: fingerprints, links by anchor points, components.

Links are pairs of fingerprints that differ in at most 3 of 64 bits. Then one of the two
halves differs in at most one bit. In the 32 bits of a half the anchors are a covering code:
the Hamming code of length 31, whose words cover every point within distance 1, times the last
bit as it is. A fingerprint has one *home* anchor, its nearest, within the covering radius 1; it
is replicated to every anchor within covering radius plus threshold, 1 + 1, of which there are at
most 17 per half. If a half of x and y differs in one bit at most, y is replicated to the home of x.
So comparing homes with replicas at each anchor finds every link, with 27 bits of key.

Exact copies meet first: everything after the fingerprints works on distinct ones. An anchor's rows are
compared in blocks inside a task, which emits a spanning forest of the links rather than all pairs. An
anchor that is home to many fingerprints has its homes cut into parts, and its replicas sent to each.
Components are found by alternating large-star and small-star steps over written tables.

Defined results: a null or wordless text has fingerprint zero and is linked like any other; fewer words
than a shingle are one shingle; repeated rows each come back. A row without id takes part, and a component's id
is the smallest id it has (null if none).
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import CHUNK_BYTES, components, quoted, slices, spread_join, staged, with_fields

SHINGLE = 3
SEED = 42
MAX_BITS = 3
# Homes of one anchor that are compared in one task; more are cut into parts.
HOMES = 2048


def _tally(joined: bytes, shingle: int) -> tuple[np.ndarray, int]:
    """How often each bit is set over the hashes of all shingles, and how many hashes there are."""
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    starts = np.concatenate([[0], gaps + 1])
    ends = np.append(gaps, len(joined))
    if len(starts) > shingle:
        starts, ends = starts[: len(starts) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    total, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(starts), CHUNK_BYTES // 16):
        some = zip(starts[i : i + CHUNK_BYTES // 16].tolist(), ends[i : i + CHUNK_BYTES // 16].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in some], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.uint32)
    return total, len(starts)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    # bytes.lower() and bytes.split() know ASCII only, as is wanted here.
    joined = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not joined:
        return 0
    total, n = _tally(joined, shingle)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_column: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without its text, with ``fingerprint`` as a signed 64-bit number."""
    kept = [c for c in docs.columns if c != text_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_column):
                found = [fingerprint(t.as_py(), shingle) for t in part[text_column]]
                signed = pa.array(np.array(found, np.uint64).astype(np.int64))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), signed], [*kept, "fingerprint"])

    return docs.select(*quoted([*kept, text_column])).mapInArrow(run, with_fields(docs, kept, "fingerprint long"))


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Of the first 31 bits: 0 for a code word, else 1 + the position of the bit to flip."""
    out = np.zeros(len(words), np.int64)
    for place in range(5):
        mask = sum(1 << i for i in range(31) if (i + 1) >> place & 1)
        out |= (np.bitwise_count(words & np.uint32(mask)).astype(np.int64) & 1) << place
    return out


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor keys of fingerprints: (row, key, whether the anchor is the row's home).

    A key is the code word with its half's number above it.
    """
    rows, keys, homes = [], [], []
    number = np.arange(len(prints))
    for half in (0, 1):
        part = (prints >> np.uint64(32 * half)).astype(np.uint32)
        syndrome = _syndrome(part)
        flip = np.where(syndrome > 0, np.uint32(1) << (np.maximum(syndrome, 1) - 1).astype(np.uint32), np.uint32(0))
        home = part ^ flip
        tag = np.uint64(half << 32)

        def add(row: np.ndarray, word: np.ndarray, is_home: bool, tag: np.uint64 = tag) -> None:
            rows.append(row)
            keys.append(word.astype(np.uint64) | tag)
            homes.append(np.full(len(row), is_home))

        add(number, home, True)
        add(number, home ^ np.uint32(1 << 31), False)
        # Code words at distance 2: pairs of positions whose numbers xor to the syndrome.
        for i in range(1, 32):
            j = i ^ syndrome
            ok = (syndrome > 0) & (j > i)
            word = part[ok] ^ np.uint32(1 << (i - 1)) ^ (np.uint32(1) << (j[ok] - 1).astype(np.uint32))
            add(number[ok], word, False)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch["fingerprint"].to_numpy(zero_copy_only=False).astype(np.uint64)
        for start in range(0, len(prints), 1 << 14):
            some = prints[start : start + (1 << 14)]
            rows, keys, homes = anchors(some)
            yield pa.RecordBatch.from_pydict(
                {"anchor": keys.astype(np.int64), "home": homes, "fingerprint": some[rows].astype(np.int64)}
            )


def _forest(own: np.ndarray, other: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links between ``own`` and ``other`` fingerprints, less those that earlier links imply."""
    nodes = np.unique(np.concatenate([own, other]))
    a, b = np.searchsorted(nodes, own), np.searchsorted(nodes, other)
    parent = np.arange(len(nodes))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = int(parent[x])
        return x

    links = []
    # Rows against blocks, so that memory stays bounded whatever the group.
    step = max(1, (1 << 20) // len(b))
    for i in range(0, len(a), step):
        near = np.bitwise_count(own[i : i + step, None] ^ other[None, :]) <= max_bits
        for r in range(near.shape[0]):
            mine = int(a[i + r])
            theirs = b[near[r]]
            # One look at the roots passes over most of what is linked already.
            theirs = theirs[parent[theirs] != root(mine)]
            for t in theirs.tolist():
                x, y = root(mine), root(t)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    links.append((int(nodes[mine]), int(nodes[t])))
    return links


def _compare(max_bits: int):
    """Links of each run of rows with the same key; the rows come sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            keys = _run_starts(table)
            rest, done = table.slice(keys[-1]), table.slice(0, keys[-1])
            # A run that still goes on stays; the others are complete.
            if len(done):
                yield from _links(done, keys[:-1], max_bits)
        if rest is not None and len(rest):
            yield from _links(rest, _run_starts(rest), max_bits)

    return run


def _run_starts(table: pa.Table) -> np.ndarray:
    anchor, part = table["anchor"].to_numpy(), table["part"].to_numpy()
    return np.concatenate([[0], 1 + np.flatnonzero((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]))])


def _links(table: pa.Table, starts: np.ndarray, max_bits: int) -> Iterator[pa.RecordBatch]:
    prints = table["fingerprint"].to_numpy().astype(np.uint64)
    home = table["home"].to_numpy()
    ends = np.append(starts[1:], len(prints))
    homes = np.add.reduceat(home.astype(np.int64), starts)
    found = []
    for i in np.flatnonzero((homes > 0) & (ends - starts > 1)):
        some, is_home = prints[starts[i] : ends[i]], home[starts[i] : ends[i]]
        found += _forest(some[is_home], some, max_bits)
    if found:
        pairs = np.array(found, np.uint64).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"a": pairs[:, 0], "b": pairs[:, 1]})


def links(prints: DataFrame, max_bits: int = MAX_BITS, homes: int = HOMES) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints of ``prints`` as all links do."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves with a covering threshold of 1 find links of up to 3 bits")
    rows = prints.mapInArrow(_anchor_rows, "anchor long, home boolean, fingerprint long")
    # Anchors that are home to more than one task should compare; there are at most distinct / homes.
    crowded = (
        rows.filter("home").groupBy("anchor").count().filter(F.col("count") > homes)
        .select("anchor", F.ceil(F.col("count") / homes).cast("int").alias("parts"))
    )
    counted = rows.join(crowded, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    # A home goes to its own part as such, and like any replica to all others.
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = counted.select("anchor", "fingerprint", "home", own.alias("own"), F.explode(every).alias("part")).select(
        "anchor", "part", "fingerprint", (F.col("home") & (F.col("own") == F.col("part"))).alias("home")
    )
    sorted_ = dealt.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    return sorted_.mapInArrow(_compare(max_bits), "a long, b long").filter("a <> b").distinct()


def near_duplicates(docs: DataFrame, text_column: str = "text", id_column: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (signed) and ``component_id``."""
    rows = staged(fingerprints(docs.select(id_column, text_column), text_column), "fingerprints")
    distinct = staged(rows.groupBy("fingerprint").agg(F.min(id_column).alias("least"), F.count("*").alias("rows")), "distinct")
    roots = staged(components(links(distinct.select("fingerprint"), max_bits)), "roots")
    linked = staged(roots.join(distinct, F.col("fingerprint") == F.col("node")).select("fingerprint", "root", "least"), "linked")
    least = staged(linked.groupBy("root").agg(F.min("least").alias("of_root"), F.count("*").alias("rows")), "least")
    named = spread_join(linked.drop("least"), least, "root", "rows", "fingerprint").select("fingerprint", F.col("of_root").alias("of_links"))
    classes = distinct.join(named, "fingerprint", "left").select("fingerprint", "rows", F.coalesce("of_links", "least").alias("component_id"))
    # A fingerprint may be that of a third of all rows.
    return spread_join(rows, staged(classes, "classes"), "fingerprint", "rows", id_column).select(id_column, "fingerprint", "component_id")
