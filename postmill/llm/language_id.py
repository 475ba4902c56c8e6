"""Language identification by prediction by partial matching (PPM) over bytes.

Each language has a context tree of byte counts up to ``ORDER`` bytes of context. The counts
are frozen after training, and a text's code length under a language is the sum over its
bytes of ``-log2 p(byte | longest known context)``, with an escape (method C: ``q / (n + q)`` for a
context seen ``n`` times with ``q`` distinct successors) for each step to a shorter context and
8 bits at the end. The language with the shortest code wins.

All trees share one table: a node is a byte string, with one code length and one escape cost
per language. Since counts are frozen, the code length of a known node is known once and for
all, escapes included; only strings that no language knows walk down at scoring time.

Bounds: training reads about ``DOCS_PER_LANGUAGE`` whole documents of each language, chosen by a
hash of the id (of the text, where there is none). Every language is learned, and has an equal share of the ``NODES`` longest strings
that are kept, its own most frequent ones, and ``LEAST_NODES`` at least.
Scoring reads every byte of every text, a chunk at a time; the more languages, the shorter are the chunks.

Defined results: a text that is null, or empty, or holds no letter, is ``und`` with score 0; so is
every text when there is nothing to learn from. Equal code lengths go to the first language by
name. Repeated rows each get their own row. Other input columns are passed over or kept as asked; ``identify`` replaces those
that have the names of its results.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import CHUNK_BYTES, flat_bytes, fold, quoted, slices, with_fields
from postmill.operators.ranking import top_n_per_group

ORDER = 3
DOCS_PER_LANGUAGE = 1500
NODES = 400_000
LEAST_NODES = 2_000
UNDETERMINED = "und"
PAD = 0x0A  # stands before the first byte of every text


def _grams(data: np.ndarray, n: int) -> np.ndarray:
    """Big-endian numbers of all byte strings of length ``n``, tagged with that length."""
    wide = data.astype(np.uint64)
    total = len(data) - n + 1
    out = np.full(max(total, 0), n, np.uint64)
    for i in range(n):
        out = (out << np.uint64(8)) | wide[i : i + total]
    return out


def _padded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, each behind ORDER pad bytes; starts and ends of the texts."""
    data, offsets = flat_bytes(pc.utf8_lower(pc.fill_null(texts, "")))
    lengths = np.diff(offsets)
    starts = offsets[:-1] + ORDER * np.arange(1, len(lengths) + 1)
    out = np.full(len(data) + ORDER * len(lengths), PAD, np.uint8)
    out[np.arange(len(data)) + ORDER * np.repeat(np.arange(1, len(lengths) + 1), lengths)] = data
    return out, starts, starts + lengths


def _own_grams(texts: pa.Array) -> np.ndarray:
    """The strings of ORDER + 1 bytes that end at a byte of a text."""
    data, starts, ends = _padded(texts)
    own = np.zeros(len(data) + 1, np.int8)
    np.add.at(own, starts, 1)
    np.add.at(own, ends, -1)
    inside = np.cumsum(own[:-1], dtype=np.int8) > 0
    return _grams(data, ORDER + 1)[inside[ORDER:]]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", CHUNK_BYTES):
            for lang in pc.unique(part["lang"]).to_pylist():
                rows = part.filter(pc.equal(part["lang"], lang))
                keys, counts = np.unique(_own_grams(rows["text"]), return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([lang] * len(keys), pa.string()), "gram": keys.astype(np.int64), "n": counts.astype(np.int64)}
                )


class Lookup:
    """A hash table from tagged byte strings to their positions in an array."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(10, int(4 * len(keys)).bit_length())
        self.slot_key = np.zeros(1 << self.bits, np.uint64)  # 0 is no tagged key
        self.slot_place = np.zeros(1 << self.bits, np.int32)
        waiting, at = np.arange(len(keys)), self._home(keys)
        while len(waiting):
            _, first = np.unique(at, return_index=True)
            wins = np.zeros(len(waiting), bool)
            wins[first] = True
            wins &= self.slot_key[at] == 0
            self.slot_key[at[wins]] = keys[waiting[wins]]
            self.slot_place[at[wins]] = waiting[wins]
            waiting, at = waiting[~wins], (at[~wins] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Positions; -1 for strings that are not in the table."""
        at = self._home(keys)
        there = self.slot_key[at]
        out = np.where(there == keys, self.slot_place[at], -1)
        open_ = np.flatnonzero((there != keys) & (there != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            there = self.slot_key[at[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.slot_place[at[open_[hit]]]
            open_ = open_[~hit & (there != 0)]
        return out


class ContextTrees:
    """The frozen trees: code lengths of known strings, escape costs of known contexts."""

    def __init__(self, languages: list[str], grams: np.ndarray, counts: np.ndarray):
        """``counts[i, l]``: how often language ``l`` has the i-th string of ORDER + 1 bytes."""
        self.languages = languages
        width = len(languages)
        levels = {ORDER + 1: (grams, counts)}
        for n in range(ORDER, 0, -1):
            longer, many = levels[n + 1]
            keys, place = np.unique((longer & np.uint64((1 << 8 * n) - 1)) | np.uint64(n << 8 * n), return_inverse=True)
            summed = np.zeros((len(keys), width))
            np.add.at(summed, place, many)
            levels[n] = (keys, summed)
        cost = np.full((1, width), 8.0)  # of a byte without any context: the end of the walk
        known = np.zeros(0, np.uint64)
        all_keys, all_cost, all_escape = [], [], []
        for n in range(1, ORDER + 2):
            keys, many = levels[n]
            contexts = keys >> np.uint64(8)
            # The tag of a context is one byte shorter than that of the string.
            contexts = (contexts & np.uint64((1 << 8 * (n - 1)) - 1)) | np.uint64((n - 1) << 8 * (n - 1))
            unique, place = np.unique(contexts, return_inverse=True)
            seen, distinct = np.zeros((len(unique), width)), np.zeros((len(unique), width))
            np.add.at(seen, place, many)
            np.add.at(distinct, place, many > 0)
            total = seen + distinct
            escape = np.where(total > 0, -np.log2(np.where(total > 0, distinct / np.maximum(total, 1), 1)), 0.0)
            if n == 1:
                lower = np.repeat(cost, len(keys), axis=0)
            else:
                suffix = (keys & np.uint64((1 << 8 * (n - 1)) - 1)) | np.uint64((n - 1) << 8 * (n - 1))
                lower = cost[np.searchsorted(known, suffix)]
            with np.errstate(divide="ignore"):
                direct = -np.log2(many / np.maximum(total[place], 1))
            cost, known = np.where(many > 0, direct, escape[place] + lower), keys
            all_keys.append(keys)
            all_cost.append(cost)
            all_escape.append((unique, escape))
        self.nodes, self.costs = Lookup(np.concatenate(all_keys)), np.concatenate(all_cost).astype(np.float32)
        # A context need not be a node: nothing precedes the first byte of a text but pad bytes.
        self.contexts = Lookup(np.concatenate([c for c, _ in all_escape[1:]]))
        self.escapes = np.concatenate([e for _, e in all_escape[1:]]).astype(np.float32)
        root = all_escape[0][1]
        self.root_escape = (root[0] if len(root) else np.zeros(width)).astype(np.float32)

    def code_lengths(self, grams: np.ndarray, n: int = ORDER + 1) -> np.ndarray:
        """Bits of the last byte of each string of ``n`` bytes, per language."""
        if n == 0:
            return np.full((len(grams), len(self.languages)), 8.0, np.float32)
        node = self.nodes.find(grams)
        out = self.costs[node]
        missing = np.flatnonzero(node < 0)
        if len(missing):
            rare = grams[missing]
            low = np.uint64((1 << 8 * (n - 1)) - 1)
            tag = np.uint64((n - 1) << 8 * (n - 1))
            context = ((rare >> np.uint64(8)) & low) | tag
            if n > 1:
                at = self.contexts.find(context)
                escape = np.where((at >= 0)[:, None], self.escapes[at], 0)
            else:
                escape = self.root_escape
            out[missing] = escape + self.code_lengths((rare & low) | tag, n - 1)
        return out

    def bits_of(self, texts: pa.Array) -> np.ndarray:
        """Code length of each text in bits, per language."""
        data, starts, ends = _padded(texts)
        total = np.zeros((len(starts), len(self.languages)))
        # Chunks bound the memory, as every byte has a cost in every language; a text may span several.
        chunk = max(1, CHUNK_BYTES // (4 * len(self.languages)))
        for begin in range(0, len(data), chunk):
            stop = min(begin + chunk, len(data))
            head = max(0, begin - ORDER)
            costs = self.code_lengths(_grams(data[head:stop], ORDER + 1))
            # costs[i] belongs to the byte at head + ORDER + i.
            sums = np.zeros((len(costs) + 1, costs.shape[1]))
            np.cumsum(costs, axis=0, dtype=np.float64, out=sums[1:])
            first = int(np.searchsorted(ends, head + ORDER, side="right"))
            last = int(np.searchsorted(starts, stop, side="left"))
            low = np.clip(starts[first:last] - head - ORDER, 0, len(costs))
            high = np.clip(ends[first:last] - head - ORDER, 0, len(costs))
            total[first:last] += sums[high] - sums[np.minimum(low, high)]
        return total

    def predict(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not self.languages:
            return pa.array([UNDETERMINED] * len(texts), pa.string()), pa.array(np.zeros(len(texts)))
        bits = self.bits_of(texts)
        best = bits.argmin(axis=1) if len(bits) else np.zeros(0, np.int64)
        shortest = bits.min(axis=1, keepdims=True) if len(bits) else bits
        # The posterior under equal priors.
        score = 1 / np.exp2(np.maximum(shortest - bits, -1000)).sum(axis=1)
        names = np.where(lettered, np.array(self.languages, dtype=object)[best], UNDETERMINED)
        return pa.array(names.tolist(), pa.string()), pa.array(np.where(lettered, score, 0.0))


def train(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    id_column: str = "doc_id",
    docs_per_language: int = DOCS_PER_LANGUAGE,
    nodes: int = NODES,
) -> ContextTrees:
    """Trees from the rows of ``docs`` that have a text and a language."""
    spark = docs.sparkSession
    labelled = docs.select(
        F.col(text_column).alias("text"), F.col(lang_column).alias("lang"), F.coalesce(F.col(id_column).cast("string"), F.sha2(text_column, 256)).alias("id")
    ).filter("text is not null and lang is not null")
    # One number per language comes to the driver, never documents.
    counted = labelled.groupBy("lang").count().collect()
    if not counted:
        return ContextTrees([], np.zeros(0, np.uint64), np.zeros((0, 0)))
    shares = spark.createDataFrame(
        [(r["lang"], min(1.0, docs_per_language / r["count"])) for r in counted], "lang string, share double"
    )
    place = F.pmod(F.xxhash64(F.lit("langid"), "id"), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.join(shares, "lang").filter(place < F.col("share")).select("lang", "text")
    found = sample.mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    most = max(LEAST_NODES, nodes // len(counted))
    rows = top_n_per_group(found, ["lang"], [F.desc("n"), F.asc("gram")], most).select("lang", "gram", "n").toArrow()
    if not len(rows):
        return ContextTrees([], np.zeros(0, np.uint64), np.zeros((0, 0)))
    names = sorted(r["lang"] for r in counted)
    grams, place = np.unique(rows["gram"].to_numpy().astype(np.uint64), return_inverse=True)
    counts = np.zeros((len(grams), len(names)))
    language = pc.index_in(rows["lang"], pa.array(names)).to_numpy()
    counts[place, language] = rows["n"].to_numpy()
    return ContextTrees(names, grams, counts)


def identify(docs: DataFrame, trees: ContextTrees, text_column: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` without its text column, unless it is to be kept, with ``lang_pred`` and ``score`` added.

    The trees are of bounded size (``NODES`` strings) and are sent to the tasks once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    kept = [c for c in docs.columns if c not in (text_column, "lang_pred", "score")]
    sent = [*kept, text_column]
    kept = sent if keep_text else kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, text_column):
                names, scores = model.predict(part[text_column])
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), names, scores], [*kept, "lang_pred", "score"])

    return docs.select(*quoted(sent)).mapInArrow(run, with_fields(docs, kept, "lang_pred string, score double"))


def learners(docs: DataFrame) -> DataFrame:
    """The rows a model may learn from: those of the first, second and last of four folds."""
    return docs.filter(fold("doc_id", 4) != 2)


def predicted_languages(docs: DataFrame) -> DataFrame:
    """Learn from the training folds of ``docs`` and predict the language of every row."""
    rows = docs.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "text")
    return identify(rows, train(learners(docs)))
