"""Best-fit packing of token sequences, planned over the histogram of lengths.

Documents are tokenised and cut into pieces of at most ``CAPACITY`` tokens. The plan is made
from the number of pieces of each length alone, at most ``CAPACITY`` numbers: lengths are taken from the longest
down, and all pieces of a length go at once into the open sequences whose free space fits best (best-fit
decreasing over counts). A plan row says: pieces of this length with ranks from here on go to these
sequences at this offset. A piece then finds its slot by its rank within its length.

Ranks need no global sort: each file of pieces numbers its own by length, the counts per (file, length) are summed up
over files, and a piece's rank is the sum before its file plus its number. So many pieces of one length
are spread over all tasks.

Tokens: the ids of the tokenizer, then ``END``. A text is split at ASCII white space, at which this
tokenizer always splits, and each distinct chunk is tokenised once per worker (up to a bounded
memory). Texts in which a special token is spelled out are tokenised whole. Parts that its normalizer leaves as they are
and its pattern does not split go straight to its model, if the file has the rules these patterns are written for.

Defined results: null and empty texts are the one token ``END``; repeated rows each get pieces of their
own; a null doc_id is kept; an empty table gives no rows. Longer texts than ``CAPACITY`` give full pieces and at most one shorter.
"""

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenizers import Tokenizer, pre_tokenizers

from postmill.llm.common import encoded_words, slices, staged

CAPACITY = 4096
END = 1
# Distinct words, and parts of words, a worker remembers; bytes of text looked at together, parts
# handed to the tokenizer at a time, and words whose ids are put in a row at a time.
MEMORY = 600_000
TEXT_BYTES = 1 << 20
AT_ONCE = 2000
WORDS_AT_ONCE = 100_000

# Fixed pattern of the tokenizer's own splitting, for lower-case text of ASCII and Latin-1 letters.
_PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
_PLAIN = re.compile(r"[!-~ß-öø-ÿ]*")
# The tokenizer's rules that these patterns, and the model's spelling of letters, stand for.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
_BYTES = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
_SPELLED = {ord(c): _BYTES.pre_tokenize_str(c)[0][0] for c in map(chr, range(ord("ß"), ord("ÿ") + 1))}


def packing_tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed vocabulary file is; the same on every machine of a cluster."""
    return public_tokenizers.path(name)


class ChunkTokenizer:
    """Ids of texts, remembering the ids of parts of words."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            ends[number] = token.endswith("</w>")
        self.ends = ends
        rules = json.loads(self.tokenizer.to_str())
        self.model = self.tokenizer.model if all(rules[k] == v for k, v in _RULES.items()) else None
        # A part of a word may be a word itself, so one memory serves for both.
        self.known: dict[str, bytes] = {}
        self.raw = [np.array([i], "<u4").tobytes() for i in range(len(ends))]

    def _learn(self, parts: list[str]) -> None:
        """Ids of parts that stand alone; each part's last token, and no other, ends a word."""
        if self.model:
            known, raw, tokens = self.known, self.raw, self.model.tokenize
            for part in parts:
                known[part] = b"".join([raw[t.id] for t in tokens(part if part.isascii() else part.translate(_SPELLED))])
            return
        for i in range(0, len(parts), AT_ONCE):
            some = parts[i : i + AT_ONCE]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some):
                raise ValueError("the tokenizer does not end every word with a word end")
            raw, at = ids.tobytes(), 0
            for part, cut in zip(some, (4 * cuts).tolist(), strict=True):
                self.known[part] = raw[at:cut]
                at = cut

    def _new_words(self, words: list[str]) -> list[bytes]:
        # A word of ASCII letters is one part.
        split = [[w] if w.isascii() and w.isalpha() else _PART.findall(w) if _PLAIN.fullmatch(w) else None for w in words]
        known = self.known
        new = dict.fromkeys(p for parts in split if parts for p in parts if p not in known)
        if len(known) + len(new) + len(words) > MEMORY:
            # Start again with all parts of this call.
            known.clear()
            new = dict.fromkeys(p for parts in split if parts for p in parts)
        self._learn(list(new))
        ids = [
            (known[parts[0]] if len(parts) == 1 else b"".join([known[p] for p in parts])) if parts else self._whole(word)
            for word, parts in zip(words, split, strict=True)
        ]
        known.update(zip(words, ids, strict=True))
        return ids

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, as little-endian 32-bit numbers."""
        codes, words, counts = encoded_words(texts)
        # By way of numpy, as a list of Arrow strings is slow to make.
        distinct = words.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.get, distinct))
        new = [i for i, known in enumerate(ids) if known is None]
        for i, found in zip(new, self._new_words([distinct[i] for i in new]), strict=True):
            ids[i] = found
        special = pc.fill_null(pc.match_substring(texts, "<|"), False).to_pylist()
        flat, sizes = np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts, ends = np.cumsum(sizes) - sizes, np.concatenate(([0], np.cumsum(sizes[codes])))
        joined = np.empty(ends[-1], "<u4")
        for i in range(0, len(codes), WORDS_AT_ONCE):
            some = codes[i : i + WORDS_AT_ONCE]
            first, last = ends[i], ends[i + len(some)]
            joined[first:last] = flat[np.arange(first, last) + np.repeat(starts[some] - ends[i : i + len(some)], sizes[some])]
        cuts = ends[np.concatenate(([0], np.cumsum(counts)))].tolist()
        for row, is_special in enumerate(special):
            yield self._whole(texts[row].as_py()) if is_special else joined[cuts[row] : cuts[row + 1]].tobytes()


_tokenizers: dict[str, ChunkTokenizer] = {}


def tokenizer_of(path: str) -> ChunkTokenizer:
    """One tokenizer per worker and file, since workers are used for many tasks."""
    if path not in _tokenizers:
        _tokenizers[path] = ChunkTokenizer(path)
    return _tokenizers[path]


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Pieces of all documents, numbered by length within their task: ``task``, ``own_rank``."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, task = tokenizer_of(path), TaskContext.get().partitionId()
        used = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                out: dict[str, list] = {c: [] for c in ("row", "piece", "start", "length", "ids_crc32", "own_rank")}
                for row, ids in enumerate(tokenizer.encode(part["text"])):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        some = ids[at : at + 4 * capacity]
                        length = len(some) // 4
                        values = (row, piece, at // 4, length, zlib.crc32(some), used[length])
                        for column, value in zip(out.values(), values, strict=True):
                            column.append(value)
                        used[length] += 1
                doc_ids = part["doc_id"].take(pa.array(out.pop("row"), pa.int64()))
                columns = [pa.array(out["piece"], pa.int32()), *(pa.array(out[c], pa.int64()) for c in list(out)[1:])]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, *columns, pa.array([task] * len(doc_ids), pa.int32())], ["doc_id", *out, "task"]
                )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, own_rank long, task int"
    )


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best fit, decreasing, over counts: rows (length, first rank, pieces, first sequence, offset).

    Open sequences are runs of neighbours with the same free space, so a row places many
    pieces, one in each sequence of a run. The number of rows depends on the lengths, not on the counts.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    runs: dict[int, list[tuple[int, int]]] = {}  # free space: runs (first sequence, sequences)
    free: list[int] = []  # the free spaces in runs, sorted
    opened = 0

    def put(space: int, run: tuple[int, int]) -> None:
        if space not in runs:
            runs[space] = []
            free.insert(int(np.searchsorted(free, space)), space)
        runs[space].append(run)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            place = int(np.searchsorted(free, length))
            if place == len(free):
                # New sequences, each filled up with this length before the next is opened.
                each = capacity // length
                full, rest = divmod(left, each)
                for sequences, pieces in ((full, each), (1, rest)):
                    if not sequences or not pieces:
                        continue
                    for i in range(pieces):
                        rows.append((length, rank, sequences, opened, i * length))
                        rank += sequences
                    if capacity > pieces * length:
                        put(capacity - pieces * length, (opened, sequences))
                    opened += sequences
                left = 0
                continue
            space = free[place]
            first, sequences = runs[space].pop()
            if not runs[space]:
                del runs[space]
                free.pop(place)
            here = min(left, sequences)
            rows.append((length, rank, here, first, capacity - space))
            rank, left = rank + here, left - here
            if space > length:
                put(space - length, (first, here))
            if here < sequences:
                put(space, (first + here, sequences - here))
    return rows


def pack(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    capacity: int = CAPACITY,
    text_column: str = "text",
    id_column: str = "doc_id",
) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The plan has at most some ten thousand rows for any input (``plan``) and goes to all tasks.
    """
    path = tokenizer_path or packing_tokenizer_path()
    pieces = staged(pieces_of(docs, path, capacity, text_column, id_column), "pieces")
    per_task = staged(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = np.array(plan(histogram, capacity), np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    shared = docs.sparkSession.sparkContext.broadcast(table)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    bases = per_task.select("task", "length", F.coalesce(before, F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["task", "length"]).withColumn("rank", F.col("base") + F.col("own_rank"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        # Lengths and ranks as one number that orders as they do.
        scale = np.int64(1 << 45)
        keys = slots[:, 0] * scale + slots[:, 1]
        for batch in batches:
            rank = batch["rank"].to_numpy()
            slot = slots[np.searchsorted(keys, batch["length"].to_numpy() * scale + rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(slot[:, 3] + rank - slot[:, 1]), pa.array(slot[:, 4])],
                [*kept, "sequence_id", "offset"],
            )

    fields = f"doc_id {pieces.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return ranked.select(*kept, "rank").mapInArrow(place, f"{fields}, sequence_id long, offset long")
