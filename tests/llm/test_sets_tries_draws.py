"""MinHash near-duplicates, the conversation trie and importance resampling, against brute force and on odd input."""

import hashlib
import json
import math
import random
import re
import time
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_operators import LONG, SMALL, documents, odd_documents
from tokenizers import Tokenizer

from postmill.llm import common, importance, language_id, minhash, packing, prefix_trie, secrets
from postmill.llm.common import may_be_among, spread_join

# 11 MinHash near-duplicates


def brute_sets(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_near_duplicates(rows):
    sets = [brute_sets(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = least.get(root(i))
        least[root(i)] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    return sorted(((d, len(sets[i]), least[root(i)], d == least[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


def near_copies(n=60, variants=8):
    draw = random.Random(5)
    names = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(n):
        base = [draw.choice(names) for _ in range(draw.choice([3, 20, 90, 400]))]
        for v in range(variants):
            words = list(base)
            for _ in range(len(base) * v // 300):
                words[draw.randrange(len(words))] = draw.choice(names)
            rows.append((len(rows) * 7 % 1009, " ".join(words).upper() if v % 2 else "\n".join(words)))
    return rows


@pytest.mark.parametrize("part", [None, 3])
def test_near_duplicates(spark, monkeypatch, part):
    if part:
        # Every crowded band and component in many parts.
        monkeypatch.setattr(minhash, "BAND_PART", part)
        monkeypatch.setattr(minhash, "SET_PART", 200)
    rows = near_copies(20 if part else 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in minhash.near_duplicates(df).collect()), key=str)
    assert found == brute_near_duplicates(rows)
    assert len({r[2] for r in found}) < len(rows)


def test_near_duplicates_of_documents_and_odd_rows(spark):
    for df in (documents(spark), odd_documents(spark), odd_documents(spark).limit(0)):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        found = sorted((tuple(r) for r in minhash.near_duplicates(df).collect()), key=str)
        assert found == brute_near_duplicates(rows)


def test_sketches_merge_and_estimate():
    draw = np.random.default_rng(3)
    a, b = (draw.integers(0, 1 << 63, n).astype(np.uint64) for n in (700, 40))
    both = [minhash.registers(np.zeros(len(x), np.int64), np.sort(x), 1)[0] for x in (a, b, np.concatenate([a, b]))]
    assert (np.maximum(both[0], both[1]) == both[2]).all()
    for n in (1, 30, 1000):
        for share in (0.3, 0.85, 1.0):
            kept = max(1, round(n * 2 * share / (1 + share)))
            errors = []
            for _ in range(20):
                x = draw.integers(0, 1 << 63, 2 * n).astype(np.uint64)
                k, l = (minhash.registers(np.zeros(n, np.int64), x[s], 1)[0] for s in (slice(0, n), slice(n - min(kept, n), 2 * n - min(kept, n))))
                true = min(kept, n) / (2 * n - min(kept, n))
                args = np.array([0.5]), np.array([(k > l).sum()]), np.array([(k < l).sum()])
                errors.append(minhash.similarity(*args)[0] - true)
                if true >= 0.85:
                    assert minhash.may_link(k[None], l[None], np.array([n]), np.array([n])).all()
            assert abs(np.mean(errors)) < 0.04


@pytest.mark.parametrize("tight, loose", [(0, 40), (150, 0), (90, 60), (2, 1)])
def test_forest_of_a_cell_joins_what_all_its_pairs_join(tight, loose):
    rng = np.random.default_rng(7)
    group = rng.integers(0, 2**63, 60, dtype=np.uint64)
    sets = [np.concatenate([rng.permutation(group)[:57], rng.integers(0, 2**63, 3, dtype=np.uint64)]) for _ in range(tight)]
    for i in range(loose):  # chains: each shares most of its elements with the one before
        before = sets[-1] if i % 3 and sets else rng.integers(0, 2**63, 60, dtype=np.uint64)
        sets.append(np.concatenate([before[4:], rng.integers(0, 2**63, 4, dtype=np.uint64)]))
    sets = [np.sort(sets[i]) for i in rng.permutation(len(sets))]
    n = np.array([len(x) for x in sets])
    some = minhash.registers(np.repeat(np.arange(len(n)), n), np.concatenate(sets), len(n))
    near = minhash.may_link(some[:, None], some[None], n[:, None], n[None])

    def classes(pairs):
        forest = minhash._Forest(len(n))
        for a, b in pairs:
            forest.link(a, np.array([b]))
        return [forest.root(x) for x in range(len(n))]

    found = minhash._forest_of(some, n, minhash.PERCENT)
    assert all(near[a, b] for a, b in found)
    assert len(found) == len(n) - len(set(classes(found)))
    assert classes(found) == classes(np.argwhere(near).tolist())


def test_spread_join(spark):
    many = spark.createDataFrame([(7 if i < 3000 else i, i) for i in range(4000)], "k long, v long")
    few = many.groupBy("k").agg(F.count("*").alias("rows")).withColumn("name", F.col("k") * 2)
    found = spread_join(many, few, "k", "rows", "v", hot_keys=10)
    assert sorted(map(tuple, found.collect())) == sorted((7 if i < 3000 else i, i, 14 if i < 3000 else 2 * i) for i in range(4000))


def test_components_settle_in_small_steps(spark, monkeypatch, capsys):
    written, write = [], common.staged

    def staged(df, name):
        df.explain()
        plan = capsys.readouterr().out
        written.append((name, plan.count("Exchange"), plan.count("Aggregate")))
        return write(df, name)

    monkeypatch.setattr(common, "staged", staged)
    star = [(0, i) for i in range(1, 300)]
    chain = [(1000 + i, 1001 + i) for i in range(64)]
    pairs = [(2001, 2000), (2000, 2001), (3000, 3000)]
    found = common.components(spark.createDataFrame(star + chain + pairs, "a long, b long"))
    expected = {**{i: 0 for i in range(300)}, **{1000 + i: 1000 for i in range(65)}, 2000: 2000, 2001: 2000}
    assert sorted(map(tuple, found.collect())) == sorted(expected.items())
    # The driver holds the plan of one star at a time, and no round follows the one that settles.
    assert max(exchanges for _, exchanges, _ in written) <= 12 and max(aggregates for _, _, aggregates in written) <= 12
    written.clear()
    assert common.components(spark.createDataFrame(star, "a long, b long")).count() == 300
    assert [name for name, *_ in written] == ["edges", "centers", "edges", "centers", "edges"]
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keys_that_may_be_among(spark):
    rows = spark.range(20_000).select(F.xxhash64("id").alias("key"), "id")
    passed = rows.filter(may_be_among(rows.filter("id < 2000").select("key"), "key")("key"))
    assert passed.filter("id < 2000").count() == 2000 and passed.count() < 6000
    assert rows.filter(may_be_among(rows.limit(0), "key")("key")).count() == 0
    assert rows.filter(may_be_among(rows.select("key"), "key", most_bits=5)("key")).count() == 20_000


# 12 the trie of prefixes

TURNS = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    said = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            said[conv_id].append((turn is not None, turn or 0, key, role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in said.items()}
    members = defaultdict(set)
    ends = defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - int(math.fmod(c, 5))
        path = tuple(turns.get(donor, [])[:h] + turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
        ends[path].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def below(path):
        yield path
        for child in children[path]:
            yield from below(child)

    out = []
    for path, of in members.items():
        tree = list(below(path))
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in tree if p)
        listed = ",".join(map(str, sorted(ends[path])))
        out.append((min(of), len(path), min(members[path[:-1]]) if path else None, len(of), len(children[path]),
                    sum(not children[p] for p in tree), saved, hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(out)


def trie(df, shard_turns=prefix_trie.SHARD_TURNS):
    found = prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.turns(df)), shard_turns)
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(r[c] for c in columns) for r in found.collect())


def odd_turns():
    rows = [(c, t, "user" if t % 2 == 0 else None, "é" * (t + 1) if c % 3 else "same") for c in range(-12, 60) for t in range(c % 7)]
    rows += [(100, None, "user", "first"), (100, 3, None, None), (100, 3, "user", "tie"), (100, 3, "user", "tie"), (None, 0, "user", "x")]
    rows += [(2**63 - 1, 0, "", ""), (-(2**63), 0, "user", LONG), (101, 1, "user", "x" * 50)]
    return rows + [(c, t, "user", "hot") for c in range(200, 260) for t in range(12)]


@pytest.mark.parametrize("shard_turns", [1, 5, 40, prefix_trie.SHARD_TURNS])
def test_trie(spark, shard_turns):
    rows = odd_turns()
    df = spark.createDataFrame(rows, TURNS).repartition(5).withColumns({"key": F.lit(1), "bytes": F.lit(1), "depth": F.lit("x")})
    assert trie(df, shard_turns) == brute_trie(rows)


def test_trie_of_the_given_table_and_of_none(spark):
    df = spark.read.parquet(f"{SMALL}/conversations.parquet")
    assert trie(df, 20) == brute_trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert trie(df.limit(0)) == []


# 13 importance resampling


def brute_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_draw(rows, target, runs=1, buckets=10_000, percent=10, least=20):
    def counted(texts):
        out = np.zeros(buckets, int)
        for t in texts:
            for f in features(t):
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    def features(text):
        words = brute_words(text)
        return [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]

    s, t = counted(x for _, x in rows), counted(target)
    total = float(t.sum() + buckets), float(s.sum() + buckets)
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * total[1] / ((s[b] + 1.0) * total[0]))) for b in range(buckets)]
    scored = []
    for doc_id, text in rows:
        found = [gain[zlib.crc32(f.encode()) % buckets] for f in features(text)]
        weight = math.floor(Fraction(sum(found), len(found))) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((-score, doc_id is None, doc_id or 0, len(found), weight, len(brute_words(text)) >= least))
    allowed = sorted(x for x in scored if x[5])
    k = len(allowed) * percent // 100
    ranks = list(range(1, k + 1)) + [None] * (len(allowed) - k)
    out = [(None if x[1] else x[2], x[3], x[4], -x[0], r) for x, r in zip(allowed, ranks, strict=True)]
    return sorted(out + [(None if x[1] else x[2], x[3], x[4], -x[0], None) for x in scored if not x[5]], key=str)


@pytest.mark.parametrize("runs", [1, 2])
def test_draw(spark, runs):
    odd = [(None, LONG[:3000]), (None, "a b"), (5, None), (6, ""), (7, "É-é x.Y\x00z 0 " * 9)] + [(8, "some words of the same row " * 5)] * 300
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).collect()] + odd
    target = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()] + [None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit(1), "rank": F.lit("x"), "drawn": F.lit(1)})
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (0, 10, 60, 100):
        found = importance.resampled(docs, wanted, percent=percent, runs=runs)
        assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted((tuple(r) for r in found.collect()), key=str) == brute_draw(rows, [t or "" for t in target], runs, percent=percent)


def test_draw_from_none(spark):
    docs = documents(spark)
    wanted = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert importance.resampled(docs.limit(0), wanted).collect() == []
    found = importance.resampled(docs, wanted.limit(0)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_draw([(r["doc_id"], r["text"]) for r in docs.collect()], [])


def test_kth_key_of_many_ties(spark):
    rows = sorted([(x % 3, x // 40) for x in range(1500)] + [(1, 1)] * 500)
    df = spark.createDataFrame(rows, "a long, b long")
    for k in (1, 2, 700, 701, 1200, 2000):
        assert importance.kth_key(df, ["a", "b"], k, pivots=2) == rows[k - 1]
    assert importance.kth_key(df, ["a", "b"], 2001) is None


# Found in earlier operators


def test_every_language_is_learned(spark):
    alphabets = [chr(0x4E00 + 40 * i) + chr(0x4E01 + 40 * i) for i in range(70)]
    rows = [(None if n % 2 else 1000 * i + n, f"{a}{a[::-1]} {a} " * (3 + n), f"l{i:02}") for i, a in enumerate(alphabets) for n in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("own"))
    trees = language_id.train(docs, docs_per_language=4)
    assert len(trees.languages) == 70
    found = language_id.identify(docs, trees)
    assert found.columns == ["doc_id", "lang", "lang_pred", "score"]
    right = [r["lang"] == r["lang_pred"] for r in found.collect()]
    assert sum(right) >= 0.95 * len(right)


def test_secrets_in_hostile_texts_take_linear_time():
    started = time.monotonic()
    header = "-----BEGIN PRIVATE KEY-----\n"
    assert secrets.find_secrets(header * (1_000_000 // len(header))) == []
    assert secrets.find_secrets("eyJ" * 333_000) == []
    assert secrets.find_secrets("eyJ.eyJ" * 140_000) == []
    assert time.monotonic() - started < 10


def test_keys_and_tokens_are_those_of_the_patterns():
    pem = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:(?!-----END)[\s\S])*-----END [A-Z ]{0,40}PRIVATE KEY-----")
    jwt = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
    draw = random.Random(1)
    pieces = ["-----BEGIN PRIVATE KEY-----", "-----END PRIVATE KEY-----", "-----BEGIN RSA PRIVATE KEY", "-----END X-----", "-----", "eyJ", "eyJabcdefgh", ".", "abcdefgh", "a", " ", "eyJeyJ12345678"]
    for _ in range(4000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randrange(1, 16)))
        assert list(secrets.find_keys(text)) == [m.span() for m in pem.finditer(text)]
        assert list(secrets.find_tokens(text)) == [m.span() for m in jwt.finditer(text)]


def test_texts_are_not_moved_but_for_copies_known_ones_and_findings(spark, path, monkeypatch):
    """Rows with a text that enter a deduplication or a join; both shuffle them once there are many."""
    clean = [f"clean text number {i}" for i in range(400)]
    found = [f"password=abcdef{i} and more" for i in range(20)]
    texts = [*clean, *found, found[0], found[0], "a clean copy", "a clean copy", None, None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    secrets.scan_new(docs.filter("doc_id < 5"), path("ledger"))
    moved = []

    def watched(name):
        real = getattr(type(docs), name)

        def run(self, *args, **kwargs):
            if "text" in self.columns:
                moved.append(self.count())
            return real(self, *args, **kwargs)

        monkeypatch.setattr(type(docs), name, run)

    watched("dropDuplicates")
    watched("join")
    spans = {r["doc_id"]: r["spans"] for r in secrets.with_spans(docs, path("ledger"), name="spans").collect()}
    assert moved and max(moved) < 40
    assert len(spans) == len(texts)
    assert all([tuple(s) for s in spans[i] or []] == secrets.find_secrets(t or "") for i, t in enumerate(texts))
    assert secrets.read_ledger(spark, path("ledger")).count() == len({t or "" for t in texts})


# 6 packing


def test_ids_of_plain_words_come_from_the_model_alone(tmp_path, monkeypatch):
    path = packing.packing_tokenizer_path()
    whole, draw = Tokenizer.from_file(path), random.Random(3)
    pieces = [*"abcdeßéöøÿ0123'.,-!~", "'s", "'re", "'ll", "ing", "tion", "aujourd'hui", "größe"]
    words = ["".join(draw.choice(pieces) for _ in range(draw.randrange(1, 9))) for _ in range(3000)]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randrange(40))) for _ in range(300)]
    odd = ["", None, " \t\n", "É ÷ Ω x   café", "a <|endoftext|> b", "AbC \x1c \x7f", "the the the"]
    mixed = pa.array([t for pair in zip(texts, odd * 50) for t in pair])

    def expected(text):
        return np.array(whole.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()

    class Unused:
        def encode(self, *args, **kwargs):
            raise AssertionError("normalizer and pattern were run")

    monkeypatch.setattr(packing, "WORDS_AT_ONCE", 7)
    fast = packing.ChunkTokenizer(path)
    real, fast.tokenizer = fast.tokenizer, Unused()
    assert list(fast.encode(pa.array(texts))) == [expected(t) for t in texts]
    fast.tokenizer = real
    assert list(fast.encode(mixed)) == [expected(t) for t in mixed.to_pylist()]
    assert list(fast.encode(pa.array(["", None], pa.string()))) == [b"", b""]

    # A memory that overflows, and a file with other rules, which the model alone does not know.
    monkeypatch.setattr(packing, "MEMORY", 100)
    assert list(fast.encode(mixed)) == [expected(t) for t in mixed.to_pylist()]
    rules = json.loads(whole.to_str())
    rules["normalizer"]["normalizers"].append({"type": "Replace", "pattern": {"String": "a"}, "content": "e"})
    (tmp_path / "other.json").write_text(json.dumps(rules))
    other, whole = packing.ChunkTokenizer(str(tmp_path / "other.json")), Tokenizer.from_file(str(tmp_path / "other.json"))
    assert list(other.encode(mixed)) == [expected(t) for t in mixed.to_pylist()]
