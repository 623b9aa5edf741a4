"""Ranked search, toxic spans and collocations against plain Python."""

import math
import re
from collections import Counter
from itertools import product

import numpy as np
import pytest

from stratalake.llm import collocations as phrases
from stratalake.llm import ranking, toxicity
from stratalake.llm.workers import share_package

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(autouse=True)
def workers(spark):
    share_package(spark)


def plain_ranking(docs, items, k):
    pattern = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    held = [(d, Counter(pattern.findall((t or "").translate(LOWER)))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    total, df = sum(sum(c.values()) for _, c in held), Counter(t for _, c in held for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(pattern.findall((text or "").translate(LOWER)))
    out = []
    for item, terms in wanted.items():
        scores = []
        for d, c in held:
            m = 50 + 50 * sum(c.values()) * len(held) // total
            score = sum(int(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def test_ranking(spark, rows, monkeypatch):
    rng = np.random.default_rng(3)
    vocabulary = ["Über", "alpha", "BETA", "x1", "日本", "a-b", "été", *(f"w{i}" for i in range(40))]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(1, 60))) for _ in range(300)]
    docs = [(i // 2 if i % 7 else None, t) for i, t in enumerate(texts)]
    docs += [(900, None), (901, ""), (902, "--- !"), (903, "w1 " * 50_000), (5, texts[10]), (5, texts[10])]
    items = [(i, " ".join(rng.choice(vocabulary, 12))) for i in range(9)] + [(None, "alpha w3"), (None, "w4"), (3, "BETA"), (20, None), (21, "nowhere"), (22, "")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS rank", "2 AS score", "3 AS item_id").repartition(5)
    i = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS doc_id", "2 AS n")
    want = plain_ranking(docs, items, 20)
    assert rows(ranking.rank_documents(d, i, 20)) == want
    for name, value in (("TERM_TILE", 4), ("ITEM_TILE", 2), ("DOCUMENT_TILE", 3), ("BLOCK_BYTES", 40)):
        monkeypatch.setattr(ranking, name, value)
    assert rows(ranking.rank_documents(d, i, 20)) == want
    assert rows(ranking.rank_documents(d.limit(0), i)) == rows(ranking.rank_documents(d, i.limit(0))) == []


def test_partial_sums_stay_exact():
    weights = np.full(10, 2**53 // (3 * ranking._MAX_IMPACT), np.int64)
    tiles = ranking.item_tiles([np.arange(10)], weights)
    for _, _, parts in tiles:
        assert all(int(w.sum(axis=0).max()) * ranking._MAX_IMPACT < 2**53 for _, w in parts)
    assert sum(len(p) for p, _ in tiles[0][2]) == 10


def plain_collocations(docs, min_count, max_words, top):
    f, n = {}, Counter()
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    key = lang, tuple(w[i : i + k])
                    f[key] = f.get(key, 0) + 1
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    scored = []
    for (lang, w), a in found.items():
        score, _, left, right = min((10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        longer = [b for (x, v), b in found.items() if x == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))]
        if not any(100 * b >= 50 * a for b in longer):
            scored.append((lang, -score, -a, " ".join(w).encode(), left, right))
    out = []
    for lang in n:
        best = sorted(x for x in scored if x[0] == lang)[:top]
        out += [(lang, r, p.decode(), -a, left, right, n[lang], -s) for r, (_, s, a, p, left, right) in enumerate(best, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("burst, spill, words", [(4096, 600_000, 3), (3, 40, 3), (2, 25, 4)])
def test_collocations(spark, rows, monkeypatch, burst, spill, words):
    monkeypatch.setattr(phrases, "SPILL", spill)
    rng = np.random.default_rng(5)
    vocabulary = ["New", "york", "CITY", "the", "été", "日本", "of", *(f"w{i}" for i in range(12))]
    weights = 1 / np.arange(1, len(vocabulary) + 1)

    def text():
        w = list(rng.choice(vocabulary, rng.integers(1, 50), p=weights / weights.sum()))
        marks = rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\v"], len(w), p=[0.7, 0.05, 0.05, 0.05, 0.05, 0.05, 0.05])
        return "".join(a + b for a, b in zip(w, marks)) + " new york city hall"

    docs = [(str(lang) if (lang := rng.choice(["en", "de", ""])) else None, text()) for _ in range(250)]
    docs += [("en", None), ("en", ""), (None, "...,"), ("und", "new york " * 3_000), ("fr", "once only"), docs[0], docs[0]]
    df = spark.createDataFrame(docs, "lang string, text string").selectExpr("*", "1 AS n", "2 AS phrase", "3 AS rank").repartition(6)
    counter = phrases.Counter.__init__

    def small(self, length, filters, limit):
        counter(self, length, filters, spill)
        self.trie.burst = burst

    monkeypatch.setattr(phrases.Counter, "__init__", small)
    assert rows(phrases.collocations(df, 10, words, 40)) == plain_collocations(docs, 10, words, 40)
    assert rows(phrases.collocations(df.limit(0))) == []


def test_trie_bursts_and_spills():
    rng = np.random.default_rng(1)
    trie, want, got = phrases.HatTrie(63, burst=4), Counter(), Counter()
    for _ in range(300):
        a, b, c = rng.integers(1, 9, (3, 40)).astype(np.uint64)
        block = a << np.uint64(42) | b << np.uint64(21) | c
        trie.add(block)
        want.update(block.tolist())
        if trie.size > 100:
            assert isinstance(trie.root, list) and trie.size == sum(c.size for c in trie.containers())
            for keys, counts in trie.spill(50):
                got.update(dict(zip(keys.tolist(), counts.tolist())))
            assert trie.size <= 50
    for keys, counts in trie.spill(0):
        got.update(dict(zip(keys.tolist(), counts.tolist())))
    assert got == want and trie.size == 0


def test_phrase_counts_beyond_64_bits(spark):
    counts = spark.createDataFrame([("en", "a", 3 * 10**15, 1), ("en", "b", 4 * 10**15, 1), ("en", "a b", 2 * 10**15 + 1, 2)], "lang string, phrase string, a bigint, words int")
    original = phrases.phrase_counts
    phrases.phrase_counts = lambda *_: (counts, spark.createDataFrame([("en", 10**16)], "lang string, n bigint"))
    try:
        (row,) = phrases.collocations(None).collect()
    finally:
        phrases.phrase_counts = original
    assert row["score"] == 10**6 * (2 * 10**15 + 1) ** 2 // (12 * 10**30)


def test_field_marginals_and_gradient():
    rng = np.random.default_rng(2)
    e, moves = rng.normal(size=9), rng.normal(size=4)
    first, length = np.array([0, 4, 5]), np.array([4, 1, 4])
    forward, backward = toxicity.odds(e, first, length, moves)
    p = forward * backward / (1 + forward * backward)
    for a, n in zip(first, length):
        total, on = 0.0, np.zeros(n)
        for tags in product((0, 1), repeat=int(n)):
            score = moves[0] * tags[0] + sum(e[a + i] * t for i, t in enumerate(tags))
            score += sum({(0, 0): 0, (0, 1): moves[1], (1, 0): moves[2], (1, 1): moves[3]}[x] for x in zip(tags, tags[1:]))
            total += math.exp(score)
            on += np.array(tags) * math.exp(score)
        assert np.allclose(p[a : a + n], on / total)


def test_toxicity(spark):
    rng = np.random.default_rng(8)
    words = [f"{a}{b}" for a in ("ba", "de", "lo", "mi", "su") for b in ("na", "ter", "lin", "go", "rau", "ß")]
    bad = ["vermin", "filth", "Drecksack", "dreckig"]

    def text(toxic):
        w = list(rng.choice(words, rng.integers(20, 120)))
        for _ in range(rng.integers(2, 5) if toxic else 0):
            w.insert(int(rng.integers(0, len(w))), str(rng.choice(bad)))
        return " ".join(x + ("." if rng.random() < 0.1 else "") for x in w)

    toxic = rng.random(800) < 0.2
    docs = [(i, text(t)) for i, t in enumerate(toxic)]
    labels = [(i, int(t)) for i, t in enumerate(toxic)] + [(None, 1), (3, None), (7, 0)]
    docs += [(2_000, None), (2_001, ""), (2_002, "..."), (None, docs[0][1]), (2_003, "bana " * 60_000 + "filth!"), (2_004, "filth"), (1, docs[1][1])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS toxic", "2 AS score", "3 AS spans").repartition(4)
    lab = spark.createDataFrame(labels, "doc_id bigint, toxic int").selectExpr("*", "'x' AS text")
    got = toxicity.toxicity(d, lab).collect()
    assert len(got) == len(docs)
    by_id = {r["doc_id"]: r for r in got}
    held = [i for i in range(800) if by_id[i]["held_out"]]
    assert 100 < len(held) < 220 and by_id[None]["held_out"] is False
    assert np.mean([by_id[i]["predicted"] == toxic[i] for i in held]) > 0.97
    text_of = dict(docs)
    for i in (*np.flatnonzero(toxic)[:50].tolist(), 2_003, 2_004):
        spans = [text_of[i][s["start"] : s["end"]] for s in by_id[i]["spans"]]
        assert spans and all(set(re.findall(r"\w+", s)) <= set(bad) for s in spans)
    assert by_id[2_003]["predicted"] == by_id[2_004]["predicted"] == 1
    assert all(by_id[i]["predicted"] == 0 and by_id[i]["spans"] == [] for i in (2_000, 2_001, 2_002))
    assert {r["score"] for r in got if r["doc_id"] == 1} == {by_id[1]["score"]}
    assert toxicity.toxicity(d.limit(0), lab).collect() == []
    assert {r["score"] < 1e-6 for r in toxicity.toxicity(d, lab.limit(0)).collect()} == {True}


def test_labels_held_out_do_not_matter(spark):
    docs = spark.createDataFrame([(i, f"good {'vile' if i % 2 else 'kind'} text {i % 5}") for i in range(120)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id bigint, toxic int")
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    a, b = ([(r["doc_id"], r["score"]) for r in toxicity.toxicity(docs, x).orderBy("doc_id").collect()] for x in (labels, flipped))
    assert a == b and all((s >= 0.5) == bool(i % 2) for i, s in a)
