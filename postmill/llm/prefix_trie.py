"""The trie of conversation prefixes, by vertical bitmaps.

A node is a distinct sequence of first turns; conversations that start with it are its members.
Conversations are dealt by ranges of their id, and a task cuts its range into shards of bounded size. A shard
indexes its turns vertically: (position, turn) has a bitset with one bit per conversation of the shard. Depth first, a
node's bitset is intersected with the postings of its next position; each non-empty result is a child, its bits counted are
its members, its lowest bit is its smallest one, and the bits of those that end there are its end list. Shards see parts of one trie: a node is
known everywhere by a digest of its path, and its shard-wise figures merge by it.

Sums over subtrees merge as well. Where a shard holds the smallest member of a node it *owns* the node, and exactly one
does. With the owner known, a shard adds up its own members' bytes, less the bytes of owned nodes, and the owned childless nodes,
below each of its nodes; the sums of all shards are those of the whole trie. So the depth of the trie costs no rounds, and a
turn that a third of all conversations share is one row per shard.

Defined results: turns are ordered by turn (null first), equal ones by a digest of role and text; null roles and texts are
empty. Rows without conv_id take no part. Without any conversation there is no node, not even the root. Other columns are passed over.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.common import staged

# Of one shard, about; one conversation is never cut.
SHARD_TURNS = 16_384
KEY_BYTES = 16
ROOT = bytes(KEY_BYTES)

_NODES = """shard long, node long, size long, parent long, key binary, parent_key binary,
    depth long, least long, n_convs long, bytes long, below long, ends string"""


def turn_key(role: Column, text: Column) -> Column:
    """A digest of role and text together."""
    both = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(both.cast("binary"), 256)), 1, KEY_BYTES)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 1), digest and UTF-8 bytes of every turn; no text moves."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    narrow = conversations.filter("conv_id is not null").select(
        "conv_id", "turn", turn_key(role, text).alias("key"), F.octet_length(text).cast("long").alias("bytes")
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "key")
    return narrow.select("conv_id", F.row_number().over(order).alias("position"), "key", "bytes")


def rebuilt(rows: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """Every conversation of ``turns`` with its first turns taken from the first one of its ``group`` ids.

    As many are taken as the CRC-32 of the id modulo ``heads`` says. A conversation also has a row at position 0, without
    turn, so that one that is left with none is still there.
    """
    ids = rows.select("conv_id").distinct()
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    own = rows.filter(F.col("position") > h)
    # At most heads - 1 turns of a donor, each for at most 2 * group - 1 ids; ids beyond the range of a long are none.
    steps = F.array(*(F.lit(i).cast("long") for i in range(1 - group, group)))
    given = (
        rows.filter((F.col("conv_id") % group == 0) & (F.col("position") < heads))
        .select(F.col("conv_id").alias("donor"), "position", "key", "bytes", F.explode(steps).alias("step"))
        .select("donor", F.try_add("donor", "step").alias("conv_id"), "position", "key", "bytes")
        .filter((F.col("conv_id") - F.col("conv_id") % group == F.col("donor")) & (F.col("position") <= h))
        .drop("donor")
    )
    given = given.join(ids, "conv_id", "left_semi")
    mark = ids.select("conv_id", F.lit(0).alias("position"), F.lit(ROOT).alias("key"), F.lit(0).cast("long").alias("bytes"))
    return own.unionByName(given).unionByName(mark)


class _Shard:
    """Conversations in the order of their ids, indexed by position and turn."""

    def __init__(self, ids: list[int], paths: list[list[bytes]], sizes: list[list[int]]):
        self.ids, self.paths, self.sizes = ids, paths, sizes
        self.postings: dict[tuple[int, bytes], int] = {}
        self.ends: dict[int, int] = {}
        for i, path in enumerate(paths):
            bit = 1 << i
            for position, key in enumerate(path):
                self.postings[position, key] = self.postings.get((position, key), 0) | bit
            self.ends[len(path)] = self.ends.get(len(path), 0) | bit
        # Bytes of a conversation's turns from each position on.
        self.rest = [np.append(np.cumsum(np.array(s[::-1], np.int64))[::-1], 0).tolist() for s in sizes]

    def members(self, bits: int) -> Iterator[int]:
        while bits:
            low = bits & -bits
            yield low.bit_length() - 1
            bits ^= low

    def nodes(self) -> Iterator[list]:
        """Rows of ``_NODES`` in depth-first order, without shard; a node's size counts the nodes of its subtree."""
        rows: list[list] = []
        # (bitset, depth, key, parent's number and key, bytes of the last turn); a number alone closes that node.
        open_: list = [((1 << len(self.ids)) - 1, 0, ROOT, -1, ROOT, 0)]
        while open_:
            entry = open_.pop()
            if isinstance(entry, int):
                rows[entry][1] = len(rows) - entry
                continue
            bits, depth, key, parent, parent_key, n_bytes = entry
            number, count = len(rows), bits.bit_count()
            first = (bits & -bits).bit_length() - 1
            ending = bits & self.ends.get(depth, 0)
            ends = ",".join(str(self.ids[i]) for i in self.members(ending)) if ending else None
            # What the members say in this turn and after it.
            below = count * n_bytes + (self.rest[first][depth] if count == 1 else sum(self.rest[i][depth] for i in self.members(bits)))
            rows.append([number, 1, parent, key, parent_key, depth, self.ids[first], count, n_bytes, below, ends])
            open_.append(number)
            left = bits ^ ending
            while left:
                low = (left & -left).bit_length() - 1
                turn = self.paths[low][depth]
                child = left & self.postings[depth, turn]
                left ^= child
                child_key = hashlib.blake2b(key + turn, digest_size=KEY_BYTES).digest()
                open_.append((child, depth + 1, child_key, number, key, self.sizes[low][depth]))
        yield from rows


def _shards(shard_turns: int):
    names = [f.strip().split()[0] for f in _NODES.split(",")]

    def emit(ids: list[int], paths: list[list[bytes]], sizes: list[list[int]]) -> Iterator[pa.RecordBatch]:
        rows = list(_Shard(ids, paths, sizes).nodes())
        columns = [[ids[0]] * len(rows), *(list(c) for c in zip(*rows, strict=True))]
        kinds = [pa.int64()] * 4 + [pa.binary()] * 2 + [pa.int64()] * 5 + [pa.string()]
        yield pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, paths, sizes, held = [], [], [], 0
        for batch in batches:
            for conv_id, position, key, n_bytes in zip(*(batch[c].to_pylist() for c in ("conv_id", "position", "key", "bytes")), strict=True):
                if position == 0:
                    if held >= shard_turns:
                        yield from emit(ids, paths, sizes)
                        ids, paths, sizes, held = [], [], [], 0
                    ids.append(conv_id)
                    paths.append([])
                    sizes.append([])
                else:
                    paths[-1].append(key)
                    sizes[-1].append(n_bytes)
                held += 1
        if ids:
            yield from emit(ids, paths, sizes)

    return run


def _below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the subtree of each node of a shard; the nodes of a shard come one after the other, in their order."""

    def emit(rows: pa.Table) -> pa.RecordBatch:
        number = {c: rows[c].to_numpy() for c in ("node", "size", "parent", "least", "bytes", "below", "of_all", "n_children")}
        owned = number["least"] == number["of_all"]

        def subtree(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[number["node"] + number["size"]] - sums[number["node"]]

        saved = number["below"] - subtree(np.where(owned, number["bytes"], 0))
        leaves = subtree((owned & (number["n_children"] == 0)).astype(np.int64))
        parent = pa.array(number["of_all"][number["parent"]], mask=number["parent"] < 0)
        out = {"key": rows["key"], "depth": rows["depth"], "conv_id": rows["of_all"], "parent_conv_id": parent}
        out |= {"n_convs": rows["n_convs"], "n_children": rows["n_children"], "n_leaves": leaves, "saved_tokens": saved}
        return pa.table(out).combine_chunks().to_batches()[0]

    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        shard = table["shard"].to_numpy()
        starts = np.concatenate([[0], 1 + np.flatnonzero(shard[1:] != shard[:-1])])
        for start, stop in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            yield emit(table.slice(start, stop - start))
        rest = table.slice(int(starts[-1])) if len(table) else None
    if rest is not None and len(rest):
        yield emit(rest)


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's end lists, one list after the other as they come; no list is held beyond its turn."""
    at, digest = None, hashlib.sha256()
    for batch in batches:
        keys, found = [], []
        for key, ends in zip(batch["key"].to_pylist(), batch["ends"].to_pylist(), strict=True):
            if key != at:
                if at is not None:
                    keys.append(at)
                    found.append(digest.hexdigest())
                at, digest = key, hashlib.sha256(ends.encode())
            else:
                digest.update(b"," + ends.encode())
        if keys:
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "ends_sha256": pa.array(found, pa.string())})
    if at is not None:
        yield pa.RecordBatch.from_pydict({"key": pa.array([at], pa.binary()), "ends_sha256": pa.array([digest.hexdigest()], pa.string())})


def shard_nodes(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of every shard of ``rebuilt`` conversations."""
    dealt = paths.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "position")
    return dealt.mapInArrow(_shards(shard_turns), _NODES)


def prefix_trie(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie over conversations as ``rebuilt`` gives them.

    conv_id is the smallest member, parent_conv_id the parent's (root: null); n_convs members, n_children children, n_leaves
    childless nodes of the subtree; saved_tokens the bytes that sharing prefixes saves in the subtree; ends_sha256 the
    digest of the ids that end at the node.
    """
    local = staged(shard_nodes(paths, shard_turns), "shards")
    nodes = local.groupBy("key").agg(F.min("least").alias("of_all"), F.any_value("parent_key").alias("parent_key"), F.max("depth").alias("depth"))
    nodes = staged(nodes, "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("n_children"))
    of_all = nodes.select("key", "of_all").join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    known = local.drop("parent_key", "ends").join(of_all, "key")
    figures = "key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    sums = known.repartition("shard").sortWithinPartitions("shard", "node").mapInArrow(_below, figures)
    # Shards are ranges of ids, so their end lists follow each other.
    lists = local.filter("ends is not null").select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")
    hashes = lists.mapInArrow(_end_hashes, "key binary, ends_sha256 string")
    merged = sums.unionByName(hashes, allowMissingColumns=True).groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.min("parent_conv_id").alias("parent_conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.max("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
        F.coalesce(F.max("ends_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
    return merged.drop("key")
