"""The operators against brute force, and on odd input."""

import hashlib
import itertools
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postmill.llm import (
    decontaminate, html_text, language_id, licenses, lm_score, packing, queries, secrets, simhash, topk, toxicity,
)

SMALL = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, lang string, source string, n_chars long, fingerprint long, score double, spans string, row_number long"
LONG = "wort haus " * 30_000


def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names operators use themselves."""
    texts = [None, "", "  \n ", "a", "the cat sat on the mat", "the cat sat on the mat", LONG, "password = hunter22"]
    rows = [(i if i != 4 else None, t, "en", "s", None, 1, 0.5, "x", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[5], rows[7]], DDL)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def words(text):
    return (text or "").encode().lower().split()


def test_words_are_split_at_ascii_space_only():
    texts = pa.array(["x", " A b\x0bC\x1cd\n", None, "", "É e"])
    found, counts = queries_words(texts.slice(1))
    assert found == ["a b", "c\x1cd", "É", "e"] and counts == [2, 0, 0, 2]


def queries_words(texts):
    from postmill.llm.common import words_of

    found, counts = words_of(texts)
    return found.to_pylist(), counts.tolist()


# 1 top-k


def brute_top_k(rows, k, asks):
    good = {i: np.floor(64 * np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in filter(asks, good):
        scores = [(-int(good[q] @ good[c]), c) for c in good if c != q and len(good[c]) == len(good[q])]
        out += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_top_k(spark):
    draw = np.random.default_rng(0)
    centers = draw.normal(size=(6, 8))
    rows = [(i, (centers[i % 6] + draw.normal(0, 0.05, 8)).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)]  # many copies of one vector
    rows += [(2000, None), (2001, [None] * 8), (2002, [math.nan] * 8), (2003, [math.inf] + [0.0] * 7), (2004, [1.0]), (2020, [2.0]), (2040, []), (None, [1.0] * 8), (40, rows[40][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    found = topk.top_k(df, F.col("vec_id") % 20 == 0, 5, queries_per_block=16, least_slices=3, rows_per_slice=100)
    assert sorted(map(tuple, found.collect())) == brute_top_k(rows, 5, lambda i: i % 20 == 0)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_trees_prune_and_large_numbers_stay_exact():
    draw = np.random.default_rng(1)
    points = np.concatenate([np.floor(64 * (draw.normal(size=4) * 9 + draw.normal(0, 0.01, (300, 4)))) for _ in range(8)])
    search = topk.Search(np.arange(300), points[:300], 3)
    search.add(np.arange(300, 2400), points[300:])
    assert search.products < 300 * 2100 / 2
    copies = topk.Search(np.arange(3000), np.ones((3000, 4)), 2)
    copies.add(np.arange(3000), np.ones((3000, 4)))
    assert copies.found[5].tolist() == [0, 1] and copies.found[0].tolist() == [1, 2]
    wide = topk.Search(np.arange(40), np.array([[10.0**n] for n in range(260, 300)]), 1, leaf=2)
    wide.add(np.arange(40, 80), np.array([[10.0**n] for n in range(260, 300)]))
    assert (wide.found[:, 0] == 40).all() and (wide.scores[:, 0] == 2**63 - 1).all()
    big = np.array([[2.0**52, 1.0], [2.0**40, 2.0**40]])
    assert topk.exact_products(big, big).tolist() == [[2**63 - 1, 2**63 - 1], [2**63 - 1, 2**63 - 1]]


def test_trees_of_the_given_vectors_have_levels():
    rows = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    points = np.floor(64 * np.array(rows["embedding"].to_pylist(), np.float64))
    ids = rows["vec_id"].to_numpy()
    asks = ids % 20 == 0
    search = topk.Search(ids[asks], points[asks], 20, leaf=16)
    tree = search.tree
    assert tree.end[0] > tree.begin[0] and (tree.end > tree.begin).sum() > 1
    for node in range(len(tree.first)):
        mine = tree.order[tree.first[node] : tree.last[node]]
        assert (np.linalg.norm(tree.points[mine] - tree.points[tree.centers[node]], axis=1) <= tree.radius[node] + 1e-9).all()
    for at in range(0, len(ids), 700):
        search.add(ids[at : at + 700], points[at : at + 700])
    assert search.pairs > 0 and search.pruned > 0
    for n, query in enumerate(ids[asks]):
        scores = (points @ points[ids == query][0]).astype(np.int64)
        best = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist(), strict=True) if i != query)[:20]
        assert list(zip((-search.scores[n]).tolist(), search.found[n].tolist(), strict=True)) == best


# 2 licences


def test_licenses_within_lines_and_blocks():
    index = licenses.Templates()
    mit = dict(licenses.TEMPLATES)["MIT"]
    line = "Copyright 2024 Jane Doe. Released under the MIT License. All else is prose."
    assert index.find(line) == [("MIT", 1.0, 25, 55)] and line[25:55] == "Released under the MIT License"
    code = "# " + mit.replace(" to deal", "\n# to deal") + "\nimport os\n" + "x = x + 1\n" * 200
    assert [(f[0], code[f[2] : f[2] + 10]) for f in index.find(code)] == [("MIT", "Permission")]
    assert index.find(mit[: len(mit) // 2]) == []
    many = (line + " ") * 20_000
    started = time.monotonic()
    assert len(index.find(many)) == 20_000 and time.monotonic() - started < 20
    for name, text in licenses.TEMPLATES:
        assert [f[0] for f in index.find("before it " + text + " and after")] == [name]


def test_windows_equal_all_windows():
    draw = np.random.default_rng(5)
    index = licenses.Templates((("x", "a b c d e f a b c d e g"), ("y", "b c d e f")), 0.6)
    for _ in range(300):
        words = draw.choice(list("abcdefg"), size=40).tolist()
        if draw.random() < 0.7:
            words[10:22] = "a b c d e f a b c d e g".split()
            words[int(draw.integers(10, 22))] = "z"
        pairs = list(zip(words, words[1:], strict=False))
        reach = set()
        for size, name, bag in index.bags:
            for at in range(len(pairs) - size + 1):
                if licenses.dice(Counter(pairs[at : at + size]), bag, 2 * size) >= 0.6 - 1e-9:
                    reach.add((name, 2 * at))
        found = {(name, start) for name, _, start, _ in index.windows(" ".join(words))}
        # One of each run, and none where no window reaches the bound.
        runs = {(n, s) for n, s in reach if (n, s - 2) not in reach}
        assert found <= reach and len(found) == len(runs)


def test_licenses(spark):
    mit = dict(licenses.TEMPLATES)["MIT"]
    text = "Prose here.\nReleased under the MIT License.\n\n" + mit.replace(" to deal", "\nto deal") + "\n\nlicense of a poet"
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "Licensed under CC BY-NC 4.0"), (5, LONG)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in licenses.best_license(licenses.scan_licenses(df.withColumn("found", F.lit(1)))).collect()}
    assert [(f["license"], text[f["start"] : f["end"]][:8]) for f in found[1]["found"]] == [("MIT", "Released"), ("MIT", "Permissi")]
    assert [found[i]["license"] for i in (2, 3, 4, 5)] == [None, None, "CC-BY-NC-4.0", None]
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_size_bounds_lose_no_template():
    index = licenses.Templates()
    for text in [t for _, t in licenses.TEMPLATES] + ["Released under MIT License today.", "of the the of the the"]:
        unit = licenses.normalized(text)
        bag = Counter(zip(unit, unit[1:], strict=False))
        scores = [(-licenses.dice(bag, b, len(unit) - 1 + m), n) for m, n, b in index.bags]
        best = min(s for s in scores) if scores else None
        assert index.best(unit) == ((-best[0], best[1]) if -best[0] >= licenses.MIN_DICE else None)


# 3 pages


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("<p>", ""), ("<p>a &amp; b&nbsp;c", "a & b c"), ("<article>x <b>y</b>z<p>q</article>", "x yz q"),
        ("<body><nav>n</nav><div class='x ad'>ad</div><main><h1>T</h1><p>long text here<script>var t='</p>'</script></main><footer>f", "T long text here"),
        ("<article><p>one<div id=comments><p>c</p></div><aside>s</aside><form>f</form><p>two</article>", "one two"),
        ("a<!-- cut off", "a"), ("a<p class='cut", "a"),
    ],
)
def test_main_text(html, text):
    assert html_text.main_text(html) == text


def test_ratios_decide_beside_and_inside_an_article():
    body = " ".join(f"<p>Paragraph {i} of the body, {'long words of prose ' * 20}</p>" for i in range(8))
    links = "".join(f"<p><b><i><a href=/{i}><u>{i}</u></a></i></b></p>" for i in range(40))
    beside = html_text.main_text(f"<div>{body}</div><article><p>Read on</p></article>")
    assert all(f"Paragraph {i} of" in beside for i in range(8))
    inside = html_text.main_text(f"<article><h1>Top</h1>{body}{links}</article>")
    assert inside.startswith("Top Paragraph 0") and "Paragraph 7" in inside and not inside.endswith("39")


def test_elements_that_hold_the_page_are_not_skipped():
    body = "".join(f"<p>{'words of the body ' * 5}{i}</p>" for i in range(6))
    text = html_text.main_text(f"<article>{body}</article>")
    for page in (
        f"<article class='post has-sidebar'>{body}</article>", f"<main class='no-comments'>{body}</main>", f"<main class=sidebar>{body}</main>",
        f"<div id='content-with-widgets'>{body}</div>", f"<form>{body}</form>", f"<form><article>{body}</article><div class=ad>buy</div></form>",
        f"<article><p class='notice'>sign up{body}</article>", f"<nav>n</nav><article>{body}</article><div class=comments>{body}{body}</div>",
    ):
        assert html_text.main_text(page) == text
    assert html_text.main_text("<div class=cookies>We use cookies</div>") == "" == html_text.main_text(f"<nav>{body}</nav>")


def test_pages(spark):
    found = queries.html_main_text(spark, SMALL)
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = {r["page_id"]: r for r in found.collect()}
    assert len(got) == len(pages)
    for page in pages:
        article = page["html"].split("<article>")[1].split("</article>")[0].split("<footer>")[0]
        import html

        assert got[page["page_id"]]["text"] == " ".join(html.unescape(re.sub("<[^>]+>", " ", article)).split())
        assert got[page["page_id"]]["n_chars"] == len(got[page["page_id"]]["text"])


def test_compound_names_of_boilerplate():
    body = "".join(f"<p>{'The body of this piece goes on for a while. ' * 6}</p>" for _ in range(4))
    for name, stays in (("cookie-banner", False), ("user-comments", False), ("site_footer", False), ("comment-list", False), ("has-sidebar", True), ("post-header", True)):
        block = f"<div class='{name}'><p>{'Other words in a block of text. ' * 8}</p></div>"
        assert ("Other" in html_text.main_text(f"<article>{body}{block}</article>")) == stays


# 4 language model


def test_lm_scores(spark):
    docs = documents(spark).select("doc_id", "text").collect()
    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in docs}
    counts = Counter(w for i, t in docs if not held[i] for w in [*words(t), b""])
    total, size = sum(counts.values()), len(counts)
    found = queries.lm_scores(spark, SMALL).collect()
    assert len(found) == len(docs)
    texts = dict(map(tuple, docs))
    for r in found:
        tokens = [*words(texts[r["doc_id"]]), b""]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (size + 1))) for w in tokens)
        assert r["base_score"] == pytest.approx(base)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(tokens), sum(counts[w] > 0 for w in tokens), total)
    out = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_lm_probabilities_sum_to_one():
    model = lm_score.LogBilinear.started(np.random.default_rng(0).integers(0, 50, (9, 9)).astype(float))
    total = 0.0
    for unit in range(9):
        stream = lm_score.Stream(np.array([3, 4, unit]), np.array([3]), 8)
        total += math.exp(model.log_probabilities(stream)[stream.word_places[2]])
    assert total == pytest.approx(1)


def test_lm_on_odd_input(spark):
    rows = odd_documents(spark)
    assert lm_score.scored_documents(rows).count() == 10
    assert lm_score.scored_documents(rows.limit(0)).count() == 0
    nothing = lm_score.score(rows.select("doc_id", "text"), rows.limit(0)).collect()
    assert all(r["n_known"] == 0 and r["base_score"] == 0 for r in nothing)


def test_pairs_are_counted_over_all_training_texts(spark, monkeypatch):
    totals, count = [], lm_score.pair_counts
    monkeypatch.setattr(lm_score, "pair_counts", lambda *a: (totals.append(count(*a).sum()), count(*a))[1])
    rows = spark.range(12_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    lm_score.score(rows.limit(1), rows)
    # Three tokens a text, each with the units before it.
    assert totals[-1] == 12_000 * 3 * lm_score.CONTEXT


# 5 decontamination


def brute_overlaps(docs, items):
    """Per pair the most equal words, then the first place, then the words, of any stretch of any alignment."""
    out = {}
    for d, text in docs:
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
        for i, item in items:
            v = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (item or "").lower())
            least = min(13, math.ceil(0.8 * len(v)))
            for shift in range(-len(v) + 1, len(w) if v else 0):
                low = max(0, shift)
                same = [w[x] == v[x - shift] for x in range(low, min(len(w), shift + len(v)))]
                if sum(same) < least:
                    continue
                for begin, end in itertools.combinations(range(len(same) + 1), 2):
                    equal = sum(same[begin:end])
                    if same[begin] and equal >= least and 5 * equal >= 4 * (end - begin):
                        out[d, i] = max(out.get((d, i), (0, 0, 0)), (equal, -low - begin, 0))
    return {pair: (-late, equal) for pair, (equal, late, _) in out.items()}


def test_overlaps(spark):
    item = " ".join(f"w{i}" for i in range(30))
    swapped = item.replace("w7 ", "zz ").replace("w19 ", "zz ")
    short = "only these five words here"
    docs = [
        (1, f"before. {item.upper()}, after"), (2, f"x {swapped} y"), (3, " ".join(item.split()[:12])), (4, None), (5, ""),
        (6, f"so {short}, yes"), (7, "only these five other words"), (8, f"{LONG} {item} {LONG}"), (1, f"before. {item.upper()}, after"), (None, item),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("words", F.lit(1))
    bench = spark.createDataFrame([(0, item), (1, short), (2, None), (3, ""), (0, item)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): (r["doc_start"], r["n_words"], r["n_equal"]) for r in decontaminate.overlaps(df, bench).collect()}
    assert found == {(1, 0): (1, 30, 30), (2, 0): (1, 30, 28), (6, 1): (1, 5, 5), (8, 0): (60_000, 30, 30), (None, 0): (0, 30, 30)}
    assert decontaminate.overlaps(df, bench.limit(0)).count() == 0 == decontaminate.overlaps(df.limit(0), bench).count()


def test_overlaps_equal_brute_force(spark):
    docs = [tuple(r) for r in documents(spark).select("doc_id", "text").orderBy("doc_id").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    # Texts and items that repeat themselves, with borders and replaced words.
    turn = [" ".join(["la", "la", "di"] * n) for n in (5, 9, 14)]
    docs += [(9000, turn[2]), (9001, "la " * 70), (9002, f"so {turn[1]} no {turn[1]}"), (9003, " ".join(f"la di{i % 7}" for i in range(60)))]
    items += [(9000, turn[0]), (9001, "la " * 20), (9002, "la la la x la la la la la"), (9003, "di la la di")]
    found = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]): (r["doc_start"], r["n_equal"]) for r in found.collect()}
    assert got == brute_overlaps(docs, items)


def test_texts_that_repeat_a_word_are_aligned_once_per_kind(spark):
    docs = spark.createDataFrame([(1, "la " * 20_000), (2, "la di " * 10_000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "la " * 100), (2, "la di " * 50)], "item_id long, text string")
    began = time.monotonic()
    found = sorted(tuple(r) for r in decontaminate.overlaps(docs, items).collect())
    assert found == [(1, 1, 0, 100, 100, True), (2, 2, 0, 100, 100, True)]
    assert time.monotonic() - began < 30


def test_contexts_are_equal_where_the_words_around_are():
    words = np.random.default_rng(3).integers(0, 2, 200)
    for reach in (1, 2, 3, 5, 8):
        padded = [9] * reach + words.tolist() + [9] * reach
        windows = [tuple(padded[i : i + 2 * reach]) for i in range(200)]
        found = decontaminate.contexts(words, reach).tolist()
        assert len(set(found)) == len(set(windows)) == len(set(zip(found, windows, strict=True)))


def test_short_items_are_reported_and_condemn_nothing(spark):
    docs = spark.createDataFrame([(1, "the cat sat"), (2, "one two three four five six seven eight")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the"), (2, "One, two, three, four, five, six, seven, nine")], "item_id long, text string")
    assert sorted((r["doc_id"], r["certain"]) for r in decontaminate.overlaps(docs, items).collect()) == [(1, False), (2, True)]
    assert [r["doc_id"] for r in decontaminate.contaminated(docs, items).collect()] == [2]


def test_every_pattern_of_replaced_words_has_a_seed():
    masks = {**decontaminate.SHORT_MASKS, **{n: decontaminate.MASKS for n in (12, 13, 14, 15, 16, 20)}}
    for n, of_length in masks.items():
        for replaced in itertools.combinations(range(n), n // 5):
            equal = [i not in replaced for i in range(n)]
            assert any(all(equal[at + i] for i in m) for m in of_length for at in range(n - m[-1]))


def test_overlaps_with_replaced_words(spark):
    random = np.random.default_rng(5)
    docs, items = [], []
    for n in [*range(1, 26), 40, 75]:
        for _ in range(12):
            i = len(items)
            item = [f"i{i}w{j}" for j in range(n)]
            inside = item.copy()
            for j in random.choice(n, n // 5, replace=False):
                inside[j] = f"other{j}"
            items.append((i, " ".join(item)))
            docs.append((i, " ".join(["before"] * 9 + inside + ["after"] * 9)))
    # One word more replaced than allowed.
    items.append((9999, "a1 a2 a3 a4 a5 a6 a7 a8 a9 a10"))
    docs.append((9999, "a1 a2 x a4 a5 x a7 a8 x a10"))
    found = decontaminate.overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(i, i) for i in range(len(items) - 1)}


# 6 packing


def test_packing(spark):
    tokenizer = Tokenizer.from_file(packing.packing_tokenizer_path())
    special = "It's 12 <|endoftext|>  x café ΣΑΣ don't'sx ***!!"
    docs = [tuple(r) for r in documents(spark).select("doc_id", "text").collect()] + [(9001, None), (9002, ""), (9003, LONG), (9004, special), (9005, special.replace("<|", "")), (None, "a")]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    expected = Counter()
    total = 0
    for i, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        for piece, at in enumerate(range(0, len(ids), 4096)):
            some = ids[at : at + 4096]
            expected[i, piece, at, len(some), zlib.crc32(np.array(some, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 4096 and len(ends) <= 1.02 * total / 4096 + 1
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("counts", [{}, {10: 3}, {1: 25}, {4: 7, 3: 9, 7: 2}, {10: 1000, 6: 500, 5: 501, 4: 499, 1: 3}])
def test_plan_is_best_fit_decreasing(counts):
    free = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [i for i, f in enumerate(free) if f >= length]
            best = min(fits, key=lambda i: free[i]) if fits else len(free)
            free[best:] = free[best:] or [10]
            free[best] -= length
    rows = packing.plan(counts, 10)
    assert sum(n for _, _, n, _, _ in rows) == sum(counts.values())
    assert len({s for _, _, n, first, _ in rows for s in range(first, first + n)}) == len(free)


# 7 near-duplicates


def brute_fingerprint(text):
    w = words(text)
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64)) if hashes else 0


def brute_components(prints):
    names = sorted(set(prints))
    group = list(range(len(names)))
    for i, a in enumerate(names):
        for j in range(i):
            if (a ^ names[j]).bit_count() <= 3:
                group = [group[j] if g == group[i] else g for g in group]
    return dict(zip(names, group, strict=True))


def test_near_duplicates(spark):
    docs = documents(spark).select("doc_id", "text").collect()
    found = queries.simhash_near_dedup(spark, SMALL).collect()
    prints = {i: brute_fingerprint(t) for i, t in docs}
    group = brute_components(prints.values())
    least = {}
    for i in sorted(prints, reverse=True):
        least[group[prints[i]]] = i
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == {i: (f"{p:016x}", least[group[p]]) for i, p in prints.items()}


@pytest.mark.parametrize("homes", [4, 2048])
def test_links_of_planted_fingerprints(spark, homes):
    draw = np.random.default_rng(5)
    prints = [int(x) for x in draw.integers(0, 2**63, 40)]
    for base in prints[:20]:
        prints.append(base ^ sum(1 << int(b) for b in draw.choice(64, 3, replace=False)))
    prints += [prints[0] ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]  # one crowded anchor
    signed = sorted({p - 2**64 if p >= 2**63 else p for p in prints})
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), homes=homes)
    roots = dict(map(tuple, simhash.components(edges).collect()))
    group = brute_components([p % 2**64 for p in signed])
    mine = {p: roots.get(p, p) for p in signed}
    assert len(set(zip(mine.values(), (group[p % 2**64] for p in signed), strict=True))) == len(set(mine.values())) == len(set(group.values()))


def test_near_duplicates_on_odd_input(spark):
    rows = odd_documents(spark)
    found = simhash.near_duplicates(rows).collect()
    assert len(found) == 10 and {r["component_id"] for r in found if r["fingerprint"] == 0} == {0}
    assert simhash.near_duplicates(rows.limit(0)).count() == 0


# 8 toxicity


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(2)
    network = toxicity.Network.random()
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    inputs = draw.normal(size=(6, toxicity.INPUTS))
    index = draw.integers(0, 5, (4, toxicity.WINDOW))
    index[0, 20:] = 5
    labels = np.array([0.0, 1, 1, 0])

    def loss():
        p = 1 / (1 + np.exp(-network.forward(inputs, index)))
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for name, gradient in network.gradients(inputs, index, labels).items():
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        network.p[name][at] += 1e-5
        up = loss()
        network.p[name][at] -= 2e-5
        assert gradient[at] == pytest.approx((up - loss()) / 2e-5, rel=1e-2), name
        network.p[name][at] += 1e-5


def test_windows_cover_every_word():
    counts = np.array([0, 1, 32, 33, 48, 49, 200])
    text, first = toxicity.windows(counts)
    covered = set()
    for t, f in zip(text, first, strict=True):
        covered |= set(range(f, min(f + toxicity.WINDOW, int(counts[: t + 1].sum()))))
    assert covered == set(range(counts.sum())) and 0 not in text


def test_toxicity_on_held_out_rows(spark):
    big = "/root/testdata/sf0.01"
    found = queries.toxicity_scores(spark, big)
    labels = spark.read.parquet(f"{big}/labels.parquet").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    assert found.count() == 1000
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert right > 0.9 * len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_toxicity_on_odd_input(spark):
    rows = odd_documents(spark)
    labels = spark.createDataFrame([(3, 1), (5, 0), (6, 0), (7, 1), (7, 1), (None, 1), (0, None)], "doc_id long, toxic int")
    found = toxicity.score(rows, toxicity.train(rows, labels)).collect()
    assert len(found) == 10 and all(r["score"] == 0 for r in found if r["doc_id"] in (0, 1, 2))
    assert toxicity.score(rows, toxicity.train(rows, labels.limit(0))).filter("score > 0").count() == 0
    assert toxicity.scored_documents(rows.limit(0), labels).count() == 0


# 9 language


def test_code_lengths_equal_the_walk_down_the_trees():
    texts = {"en": "the cat and the dog sat", "de": "der hund und die katze sass", "fr": "le chat"}
    grams, counts = zip(*(np.unique(language_id._own_grams(pa.array([t])), return_counts=True) for t in texts.values()), strict=True)
    keys = np.unique(np.concatenate(grams))
    table = np.zeros((len(keys), 3))
    for column, (g, c) in enumerate(zip(grams, counts, strict=True)):
        table[np.searchsorted(keys, g), column] = c
    trees = language_id.ContextTrees(list(texts), keys, table)

    def length(text, learned):
        seen = Counter()
        raw = b"\n\n\n" + learned.encode()
        for i in range(3, len(raw)):
            for n in range(4):
                seen[raw[i - n : i], raw[i]] += 1
        after = {}
        for (context, byte), n in seen.items():
            after.setdefault(context, {})[byte] = n
        bits, raw = 0.0, b"\n\n\n" + text.encode()
        for i in range(3, len(raw)):
            for n in range(3, -1, -1):
                here = after.get(raw[i - n : i])
                if here is None:
                    continue
                total = sum(here.values()) + len(here)
                if raw[i] in here:
                    bits -= math.log2(here[raw[i]] / total)
                    break
                bits -= math.log2(len(here) / total)
            else:
                bits += 8
        return bits

    for text in ("the hund", "xyzq ß", "", "le chat et the cat", "a" * 50):
        found = trees.bits_of(pa.array(["der", text, "cat"]))[1]
        assert found == pytest.approx([length(text, t) for t in texts.values()], rel=1e-5)
        for_chunks = language_id.CHUNK_BYTES
        language_id.CHUNK_BYTES = 5
        assert trees.bits_of(pa.array(["der", text, "cat"]))[1] == pytest.approx(found, rel=1e-5)
        language_id.CHUNK_BYTES = for_chunks


def test_languages_of_held_out_rows(spark):
    docs = documents(spark)
    found = queries.language_prediction(spark, SMALL).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) >= 0.98 * len(found)


def test_languages_on_odd_input(spark):
    rows = odd_documents(spark).unionByName(spark.createDataFrame([(50, "12 34 !?", "en")], "doc_id long, text string, lang string"), allowMissingColumns=True)
    found = language_id.predicted_languages(rows).collect()
    assert len(found) == 11 and {r["lang_pred"] for r in found if r["doc_id"] in (0, 1, 2, 50)} == {"und"}
    assert {r["lang_pred"] for r in language_id.predicted_languages(rows.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.predicted_languages(rows.limit(0)).count() == 0


# 10 secrets


def brute_spans(text):
    text = text or ""
    assign = r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    found = [("assign", *m.span()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


CASES = ["secret=token : abcdef", "TOKEN='abcdef1' paſſword=abcdef", "AKIA" + "A" * 15, "AKIA" + "A" * 16, "é" * 9 + "0" * 24, "api_key: x api-key=abcdefg apikey=abcdef"]


def test_secrets(spark):
    docs = [(i, t) for i, t in enumerate(CASES)] + [(100 + r[0], r[1]) for r in documents(spark).select("doc_id", "text").collect()] + [(90, None), (91, ""), (2, CASES[2])]
    found = secrets.with_counts(secrets.scan(spark.createDataFrame(docs, "doc_id long, text string").withColumn("spans", F.lit(1)))).collect()
    assert len(found) == len(docs)
    for r in found:
        base = brute_spans(dict(docs)[r["doc_id"]])
        kinds = Counter(s[0] for s in base)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r["base_sha256"] == hashlib.sha256(secrets.listed(base).encode()).hexdigest()
        assert set(secrets.listed(base).split(",")) <= set(r["spans"].split(","))


def test_ledger_scans_a_blob_once_per_rule_version(spark, path):
    ledger = path("ledger")
    docs = spark.createDataFrame([(1, "password=abcdef"), (2, "clean"), (3, "clean")], "doc_id long, text string")
    secrets.scan_new(docs, ledger)
    secrets.scan_new(docs, ledger)
    later = docs.union(spark.createDataFrame([(4, "new"), (5, "clean")], docs.schema))
    assert secrets.scan(later, ledger).count() == 5
    assert secrets.read_ledger(spark, ledger).count() == 3
    secrets.scan_new(later, ledger, rule_version=2)
    assert secrets.read_ledger(spark, ledger).groupBy("rule_version").count().orderBy("rule_version").collect() == [(1, 3), (2, 3)]
    assert secrets.scan(docs.limit(0)).count() == 0


def test_ledger_with_pairs_twice_and_columns_of_any_name(spark, path):
    ledger = path("ledger")
    rows = [(i, "token=abcdefg" if i % 3 else f"clean {i}", i, i, i) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rows long, `my col` long, `a.b` long")
    secrets.scan_new(docs, ledger)
    # Another scan at the same time did not see what the first one added.
    secrets.read_ledger(spark, ledger).write.mode("append").parquet(ledger)
    found = secrets.scan(docs, ledger)
    assert found.columns == ["doc_id", "rows", "my col", "a.b", "blob", "found", "base_sha256", "spans"]
    assert sorted((r[0], r[1], r[2], r[3], r["spans"]) for r in found.collect()) == [
        (i, i, i, i, "assign:0:13" if i % 3 else "") for i in range(600)
    ]
    spans = secrets.with_spans(docs, ledger, name="spans").collect()
    assert sorted((r["doc_id"], bool(r["spans"])) for r in spans) == [(i, i % 3 > 0) for i in range(600)]
    assert secrets.scan(docs.select("text"), ledger).count() == 600


def test_redaction():
    assert secrets.redacted("ab12cd", [(2, 4)]) == "ab[SECRET]cd"
    assert secrets.redacted("abcdef", [(0, 3), (2, 4), (5, 6)]) == "[SECRET]e[SECRET]"
