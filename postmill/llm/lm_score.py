"""Language-model scores of whole texts by a log-bilinear model.

The model predicts a unit from the ``CONTEXT`` units before it: the predicted vector is the sum of their vectors, each
weighted by position, and a unit's score is its inner product with the unit's own vector, plus a bias. Units are the ``HEAD`` most
frequent words, ``CLUSTERS`` groups of the other words, one for what is left, and the end of a text. A word has
the probability of its unit times its share within the unit, ``(c + 0.1) / (N + 0.1 * (V + 1))`` over the unit's own
counts. The softmax over units is computed in full, by matrix products over blocks of tokens, so the log-probabilities are normalised.

Learning from the training rows, all of it on the executors:

1. All words of all texts are counted (one shuffle, by word). This gives the base score as well.
2. Words outside the head are grouped by their last three characters, the ``SUFFIXES`` most frequent of them;
   suffixes are clustered by the head words they follow.
3. Vectors start from a factorisation of the units' pair counts. Steps 2 and 3 count pairs over all training texts; each task
   sends at most units times columns numbers.
4. One pass over all training texts: each task goes through its tokens with noise-contrastive estimation
   (``NOISE`` noise units per block, drawn by frequency) in numpy, and the tasks' parameters are averaged by tokens.

Counts of the ``BROADCAST_WORDS`` most frequent words go to all tasks; other words meet their counts by a join.

Tokens: words between ASCII white space, A-Z lowered, and an end per text. Defined results: null and empty texts are the end alone;
repeated rows each get a score; rows without id are learned from; with no training text all words are unknown.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import encoded_words, fold, quoted, slices, staged, with_fields, words_of

HEAD = 120
SUFFIXES = 2048
CLUSTERS = 126
CONTEXT = 5
DIMENSION = 16
NOISE = 32
RATE = 0.03
BLOCK = 4096
BROADCAST_WORDS = 50_000
ADD = 0.1
COUNT_BYTES = 16 << 20


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", COUNT_BYTES):
            found = pc.value_counts(words_of(part["text"])[0])
            yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], ["word", "n"])


class Units:
    """Which unit a word belongs to: head words first, then groups by suffix, the rest, and the end."""

    def __init__(self, head: list[str], suffixes: list[str], groups: np.ndarray):
        self.head = pa.array(head, pa.string())
        self.suffixes = pa.array(suffixes, pa.string())
        # One more group, for suffixes that are not listed.
        self.groups = np.append(groups, groups.max(initial=-1) + 1).astype(np.int32)
        self.rest = len(head) + int(self.groups[-1])
        self.end = self.rest + 1
        self.size = self.end + 1

    def of(self, words: pa.Array) -> np.ndarray:
        head = pc.fill_null(pc.index_in(words, value_set=self.head), -1).to_numpy(zero_copy_only=False)
        tails = pc.utf8_slice_codeunits(words, start=-3)
        suffix = pc.fill_null(pc.index_in(tails, value_set=self.suffixes), -1).to_numpy(zero_copy_only=False)
        return np.where(head >= 0, head, len(self.head) + self.groups[suffix]).astype(np.int32)


class Stream:
    """Texts as one run of units: before each text CONTEXT ends, which are no tokens, and after it its own."""

    def __init__(self, units: np.ndarray, counts: np.ndarray, end: int):
        tokens = counts + 1
        before = CONTEXT * np.arange(1, len(counts) + 1)
        self.tokens = tokens
        self.starts = np.concatenate([[0], np.cumsum(tokens)])[:-1] + before
        self.units = np.full(int(tokens.sum()) + CONTEXT * len(counts), end, np.int32)
        text = np.repeat(np.arange(len(counts)), counts)
        self.word_places = np.arange(len(units)) + text + before[text]
        self.units[self.word_places] = units
        self.real = np.zeros(len(self.units), bool)
        self.real[np.arange(int(tokens.sum())) + np.repeat(before, tokens)] = True


def _pairs(units: Units, columns: int):
    """Counts of (unit, unit at most CONTEXT before it) as one number, for earlier units below ``columns``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", COUNT_BYTES):
                codes, words, counts = encoded_words(part["text"])
                stream = Stream(units.of(words)[codes], counts, units.end)
                now = stream.units[CONTEXT:].astype(np.int64)
                total = np.zeros(units.size * columns, np.int64)
                for back in range(1, CONTEXT + 1):
                    old = stream.units[CONTEXT - back : len(stream.units) - back]
                    use = stream.real[CONTEXT:] & (old < columns)
                    total += np.bincount(now[use] * columns + old[use], minlength=len(total))
                pair = np.flatnonzero(total)
                yield pa.RecordBatch.from_pydict({"pair": pair, "n": total[pair]})

    return run


def pair_counts(docs: DataFrame, units: Units, columns: int) -> np.ndarray:
    # At most units * columns numbers come back.
    found = docs.mapInArrow(_pairs(units, columns), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(units.size * columns)
    out[found["pair"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(units.size, columns)


def clustered(rows: np.ndarray, weights: np.ndarray, clusters: int, rounds: int = 15) -> np.ndarray:
    """k-means of distributions under the Hellinger distance, from the heaviest rows that are far apart."""
    if len(rows) <= clusters:
        return np.arange(len(rows))
    points = np.sqrt((rows + 0.01) / (rows + 0.01).sum(axis=1, keepdims=True))
    centers = [int(weights.argmax())]
    gap = np.full(len(points), np.inf)
    while len(centers) < clusters:
        gap = np.minimum(gap, ((points - points[centers[-1]]) ** 2).sum(axis=1))
        centers.append(int((gap * weights).argmax()))
    middle = points[centers]
    for _ in range(rounds):
        group = (points @ middle.T * 2 - (middle**2).sum(axis=1)).argmax(axis=1)
        total = np.zeros_like(middle)
        np.add.at(total, group, points * weights[:, None])
        mass = np.bincount(group, weights, clusters)[:, None]
        middle = np.where(mass > 0, total / np.maximum(mass, 1e-9), middle)
    return np.unique(group, return_inverse=True)[1]


class LogBilinear:
    """Parameters, in one array each, and what is done with them."""

    NAMES = ("context", "target", "bias", "position")

    def __init__(self, parameters: dict[str, np.ndarray], noise: np.ndarray):
        self.p = {k: v.astype(np.float32) for k, v in parameters.items()}
        self.noise = noise.astype(np.float32)  # frequencies of units

    @classmethod
    def started(cls, pairs: np.ndarray) -> "LogBilinear":
        """From pair counts: a low-rank factorisation of their pointwise mutual information."""
        size = len(pairs)
        counts = pairs + 0.5
        joint = counts / counts.sum()
        now, old = joint.sum(axis=1), joint.sum(axis=0)
        information = np.log(joint / (now[:, None] * old[None, :]))
        left, values, right = np.linalg.svd(information)
        rank = min(DIMENSION, size)
        target, context = np.zeros((size, DIMENSION)), np.zeros((size, DIMENSION))
        target[:, :rank] = left[:, :rank] * np.sqrt(values[:rank])
        context[:, :rank] = right[:rank].T * np.sqrt(values[:rank])
        position = np.full((CONTEXT, DIMENSION), 1.5 / CONTEXT)
        return cls({"context": context, "target": target, "bias": np.log(now), "position": position}, now)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in self.NAMES])

    def with_flat(self, values: np.ndarray) -> "LogBilinear":
        out, at = {}, 0
        for k in self.NAMES:
            out[k] = values[at : at + self.p[k].size].reshape(self.p[k].shape)
            at += self.p[k].size
        return LogBilinear(out, self.noise)

    def predicted(self, units: np.ndarray, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of the units from CONTEXT before ``start``, and the predictions for start to stop."""
        x = self.p["context"][units[start - CONTEXT : stop]]
        n = stop - start
        out = np.zeros((n, DIMENSION), np.float32)
        for back in range(1, CONTEXT + 1):
            out += self.p["position"][back - 1] * x[CONTEXT - back : CONTEXT - back + n]
        return x, out

    def log_probabilities(self, stream: Stream) -> np.ndarray:
        """Natural log-probability of the unit at each place (0 where there is no token)."""
        out = np.zeros(len(stream.units), np.float64)
        for start in range(CONTEXT, len(stream.units), BLOCK):
            stop = min(start + BLOCK, len(stream.units))
            _, predicted = self.predicted(stream.units, start, stop)
            logits = predicted @ self.p["target"].T
            logits += self.p["bias"]
            own = logits[np.arange(stop - start), stream.units[start:stop]].astype(np.float64)
            top = logits.max(axis=1)
            logits -= top[:, None]
            np.exp(logits, out=logits)
            out[start:stop] = own - top - np.log(logits.sum(axis=1, dtype=np.float64))
        out[~stream.real] = 0
        return out

    def learn(self, stream: Stream, state: dict[str, np.ndarray], random: np.random.Generator) -> None:
        """One pass of noise-contrastive estimation over a stream, with Adagrad."""
        size = len(self.noise)
        cumulative = np.cumsum(self.noise, dtype=np.float64)
        for start in range(CONTEXT, len(stream.units), BLOCK):
            stop = min(start + BLOCK, len(stream.units))
            real = stream.real[start:stop].astype(np.float32)
            if not real.any():
                continue
            own = stream.units[start:stop]
            drawn = np.minimum(np.searchsorted(cumulative, random.random(NOISE) * cumulative[-1]), size - 1)
            x, predicted = self.predicted(stream.units, start, stop)
            target, bias = self.p["target"], self.p["bias"]
            offset = np.log(NOISE * self.noise)
            yes = np.einsum("ij,ij->i", predicted, target[own]) + (bias - offset)[own]
            no = predicted @ target[drawn].T + (bias - offset)[drawn]
            up = real / (1 + np.exp(np.clip(yes, -30, 30)))
            down = -real[:, None] / (1 + np.exp(-np.clip(no, -30, 30)))
            back = up[:, None] * target[own] + down @ target[drawn]
            scale = 1 / real.sum()
            d_target = _summed(own, up[:, None] * predicted, size)
            np.add.at(d_target, drawn, down.T @ predicted)
            d_bias = np.bincount(own, up, size)
            np.add.at(d_bias, drawn, down.sum(axis=0))
            d_x, d_position, n = np.zeros_like(x), np.zeros_like(self.p["position"]), stop - start
            for i in range(1, CONTEXT + 1):
                d_x[CONTEXT - i : CONTEXT - i + n] += self.p["position"][i - 1] * back
                d_position[i - 1] = np.einsum("ij,ij->j", back, x[CONTEXT - i : CONTEXT - i + n])
            d_context = _summed(stream.units[start - CONTEXT : stop], d_x, size)
            for name, step in zip(self.NAMES, (d_context, d_target, d_bias, d_position), strict=True):
                step = (step * scale).astype(np.float32)
                state[name] += step * step
                self.p[name] += RATE * step / np.sqrt(state[name] + 1e-6)


def _summed(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(rows, values[:, j], size) for j in range(values.shape[1])], axis=1)


def _learned(model: LogBilinear, units: Units):
    """Each task's parameters after its texts, as sums weighted by tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, tokens = model.with_flat(model.flat()), None, 0
        state = {k: np.full_like(v, 1e-3) for k, v in own.p.items()}
        random = np.random.default_rng(TaskContext.get().partitionId())
        for batch in batches:
            for part in slices(batch, "text"):
                codes, words, counts = encoded_words(part["text"])
                stream = Stream(units.of(words)[codes], counts, units.end)
                own.learn(stream, state, random)
                tokens += int(stream.tokens.sum())
        if tokens:
            values = own.flat().astype(np.float64) * tokens
            yield pa.RecordBatch.from_pydict(
                {"at": np.arange(len(values)), "total": values, "tokens": np.full(len(values), tokens)}
            )

    return run


def score(docs: DataFrame, learn_from: DataFrame) -> DataFrame:
    """All rows of ``docs`` (doc_id, text, others) without the text, with n_tokens, n_known, train_tokens,
    base_score and score; the model learns from the texts of ``learn_from``."""
    spark = docs.sparkSession
    texts = learn_from.select("text")
    counts = staged(texts.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    texts_learned = texts.count()
    total, size = words + texts_learned, distinct + (texts_learned > 0)
    below = ADD * (size + 1) + total

    head = [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(HEAD).collect()]
    tail = counts.join(F.broadcast(spark.createDataFrame([(w,) for w in head], "word string")), "word", "left_anti")
    by_suffix = tail.groupBy(F.expr("right(word, 3)").alias("suffix")).agg(F.sum("n").alias("n"), F.count("*").alias("words"))
    by_suffix = staged(by_suffix, "suffixes")
    listed = by_suffix.orderBy(F.desc("n"), "suffix").limit(SUFFIXES).collect()
    suffixes = [r["suffix"] for r in listed]

    loose = Units(head, suffixes, np.arange(len(suffixes)))
    after = pair_counts(texts, loose, max(len(head), 1))[len(head) : len(head) + len(suffixes)]
    groups = clustered(after, np.array([r["n"] for r in listed], np.float64), CLUSTERS)
    units = Units(head, suffixes, groups)
    start = LogBilinear.started(pair_counts(texts, units, units.size))

    found = texts.mapInArrow(_learned(start, units), "at long, total double, tokens long")
    mean = found.groupBy("at").agg((F.sum("total") / F.sum("tokens")).alias("mean")).orderBy("at").toArrow()
    model = start.with_flat(mean["mean"].to_numpy()) if len(mean) else start

    # What a unit's words have together: a head word and the end stand alone in theirs.
    in_unit, words_in_unit = np.zeros(units.size), np.zeros(units.size)
    if suffixes:
        listed_n = np.array([[r["n"], r["words"]] for r in listed], np.float64)
        np.add.at(in_unit, len(head) + units.groups[:-1], listed_n[:, 0])
        np.add.at(words_in_unit, len(head) + units.groups[:-1], listed_n[:, 1])
    all_tail = by_suffix.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    in_unit[units.rest] = all_tail[0] - in_unit.sum()
    words_in_unit[units.rest] = all_tail[1] - words_in_unit.sum()
    # log10 of what a word's (c + 0.1) is divided by; alone in its unit it has all of it.
    divisor = np.log10(in_unit + ADD * (words_in_unit + 1))
    top = counts.orderBy(F.desc("n"), "word").limit(BROADCAST_WORDS).toArrow()
    shared = spark.sparkContext.broadcast((model, units, divisor, top["word"].combine_chunks(), top["n"].to_numpy()))
    kept = [c for c in docs.columns if c not in ("text", "n_tokens", "n_known", "train_tokens", "base_score", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, units, divisor, frequent, times = shared.value
        alone = np.zeros(units.size, bool)
        alone[: len(units.head)] = alone[units.end] = True
        end_share = math.log10(texts_learned + ADD)
        for batch in batches:
            for part in slices(batch, "text"):
                codes, words, n_words = encoded_words(part["text"])
                unit = units.of(words)
                place = pc.fill_null(pc.index_in(words, value_set=frequent), -1).to_numpy(zero_copy_only=False)
                weight = np.where(place >= 0, np.log10(times[place] + ADD), 0.0) if len(times) else np.zeros(len(words))
                stream = Stream(unit[codes], n_words, units.end)
                logs = model.log_probabilities(stream) / math.log(10)
                # Within a shared unit: (c + 0.1) over the divisor; c of rare words follows by the join.
                logs[stream.word_places] += np.where(alone[unit], 0.0, weight - divisor[unit])[codes]
                text = np.repeat(np.arange(len(n_words)), n_words)
                base = np.bincount(text, weight[codes], len(n_words)) + end_share - stream.tokens * math.log10(below)
                first, last = stream.starts, stream.starts + stream.tokens
                sums = np.concatenate([[0.0], np.cumsum(logs)])
                rare = (place < 0)[codes]
                rare_words = words.take(pa.array(codes[rare]))
                ends = np.concatenate([[0], np.cumsum(np.bincount(text[rare], minlength=len(n_words)))])
                known = stream.tokens - np.diff(ends) - (texts_learned == 0)
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in kept), pa.array(stream.tokens), pa.array(known), pa.array(base),
                     pa.array(sums[last] - sums[first]),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare_words.cast(pa.string()))],
                    [*kept, "n_tokens", "n_known", "base_score", "score", "rare"],
                )

    scored = docs.select(*kept, "text").mapInArrow(
        run, with_fields(docs, kept, "n_tokens long, n_known long, base_score double, score double, rare array<string>")
    )
    # Written out, so that the number of a row stays what it is.
    scored = staged(scored.withColumn("row_number", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row_number", F.explode("rare").alias("word"))
    met = rare.join(counts, "word", "left").groupBy("row_number").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + ADD)).alias("more"), F.count("n").alias("more_known")
    )
    more, more_known = F.coalesce("more", F.lit(0.0)), F.coalesce("more_known", F.lit(0))
    return scored.drop("rare").join(met, "row_number", "left").select(
        *kept,
        "n_tokens",
        (F.col("n_known") + more_known).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )


def scored_documents(docs: DataFrame) -> DataFrame:
    """Learn from nine of ten folds of ``docs`` and score every row."""
    rows = docs.select("doc_id", (fold("doc_id", 10) == 0).alias("held_out"), "text")
    return score(rows, rows.filter(~F.col("held_out")))
