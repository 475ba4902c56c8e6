"""Vector columns: encoding text and cosine similarity, as Arrow functions over batches."""

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from postmill import settings

Encode = Callable[[Sequence[str]], np.ndarray]
# Called once per Python worker and batch stream, so a model is loaded there and not per batch.
EncoderFactory = Callable[[], Encode]

# Similarities are rounded to this many digits, so that the order of two equal vectors does
# not hang on the order of additions.
DIGITS = 9


def hashing_encoder(dimension: int = 64) -> EncoderFactory:
    """Bag-of-words counts in hashed buckets, scaled to unit length.

    It knows shared words and no meaning; for search by meaning pass a model's encoder.
    """

    def load() -> Encode:
        def bucket(token: str) -> int:
            # The first seven hex digits of the md5 sum.
            return (int.from_bytes(hashlib.md5(token.encode()).digest()[:4]) >> 4) % dimension

        def encode(texts: Sequence[str]) -> np.ndarray:
            lowered = pc.utf8_lower(pa.array(texts, pa.large_string()))
            words = pc.split_pattern_regex(lowered, "[^a-z0-9]+")
            tokens = pc.list_flatten(words).dictionary_encode()
            # Each distinct token of the batch is hashed once; column `dimension` takes the "".
            distinct = tokens.dictionary.to_numpy(zero_copy_only=False)
            hashed = np.array([bucket(t) if t else dimension for t in distinct], dtype=np.int64)
            cells = np.asarray(pc.list_parent_indices(words)) * (dimension + 1) + hashed[np.asarray(tokens.indices)]
            counts = np.bincount(cells, minlength=len(texts) * (dimension + 1)).astype(np.float64)
            counts = counts.reshape(len(texts), dimension + 1)[:, :dimension]
            lengths = np.sqrt((counts**2).sum(axis=1, keepdims=True))
            return np.divide(counts, lengths, out=np.zeros_like(counts), where=lengths > 0)

        return encode

    return load


def sentence_encoder(model_name: str = settings.MODEL_NAME) -> EncoderFactory:
    """A sentence-transformers model, where that package is installed on the executors."""

    def load() -> Encode:
        from sentence_transformers import SentenceTransformer

        model = SentenceTransformer(model_name)
        return lambda texts: model.encode(list(texts), show_progress_bar=False)

    return load


def encode_with(factory: EncoderFactory, batch_size: int = settings.EMBED_BATCH):
    """Arrow function text -> array<float>; a null text has a null vector."""

    def vectors(texts: pa.Array, encode: Encode) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.list_(pa.float32()))
        encoded = np.asarray(encode(texts.fill_null("").to_pylist()), dtype=np.float32)
        ends = np.arange(len(texts) + 1, dtype=np.int32) * encoded.shape[1]
        starts = pa.array(ends, mask=np.append(np.asarray(texts.is_null()), False))
        return pa.ListArray.from_arrays(starts, pa.array(encoded.ravel()))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = factory()
        for texts in batches:
            parts = [
                vectors(texts.slice(start, batch_size), encode)
                for start in range(0, max(len(texts), 1), batch_size)
            ]
            yield pa.concat_arrays(parts)

    return arrow_once(run, "array<float>")


def unit(vector: Sequence[float]) -> np.ndarray:
    """The direction of a vector; NaN for a zero vector, which is similar to nothing."""
    values = np.asarray(vector, dtype=np.float64)
    return values / (np.linalg.norm(values) or np.nan)


def rows_and_lengths(vectors: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as matrix rows with their lengths; NaN length where there is no direction,
    that is for a missing vector, a zero vector or one of another dimension."""
    usable = pc.fill_null(pc.equal(pc.list_value_length(vectors), dimension), False)
    whole = pc.all(usable, min_count=0).as_py()
    flat = pc.list_flatten(vectors if whole else vectors.filter(usable))
    rows = flat.to_numpy(zero_copy_only=False).reshape(-1, dimension).astype(np.float64)
    if not whole:
        spread = np.zeros((len(vectors), dimension))
        spread[np.asarray(usable)] = rows
        rows = spread
    lengths = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return rows, np.where(lengths > 0, lengths, np.nan)


def cosine_to(query: Sequence[float]):
    """Arrow function vector -> cosine similarity to ``query``; null where undefined."""
    target = unit(query)

    def run(vectors: pa.Array) -> pa.Array:
        rows, lengths = rows_and_lengths(vectors, len(target))
        return pa.array(rounded(rows @ target / lengths), from_pandas=True)

    return arrow_once(lambda batches: map(run, batches), "double")


def rounded(similarities: np.ndarray) -> np.ndarray:
    return np.round(np.clip(similarities, -1, 1), DIGITS)


def side_bits_of(planes: np.ndarray):
    """Arrow function vector -> which side of each plane it lies on, as the bits of an int."""
    weights = 1 << np.arange(len(planes))

    def run(vectors: pa.Array) -> pa.Array:
        rows, _ = rows_and_lengths(vectors, planes.shape[1])
        sides = rows @ planes.T >= 0
        return pa.array((sides @ weights).astype(np.int32))

    return arrow_once(lambda batches: map(run, batches), "int")


def arrow_once(run: Callable, returns: str, columns: int = 1):
    """An Arrow function that runs once per row.

    The optimizer copies a deterministic function into every filter on its result, a model
    run included; one marked as not deterministic stays where it is.
    """

    def one(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from run(arrays)

    def several(arrays: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        yield from run(arrays)

    return F.arrow_udf(one if columns == 1 else several, returns).asNondeterministic()
