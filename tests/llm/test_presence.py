"""Ranked search against plain scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from filelake.llm import presence as P

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, queries, k):
    """Rows ``(item, rank, id, score)``; ids that are null come last."""
    counted = [(i, Counter(t), len(t)) for i, t in ((i, terms(t)) for i, t in docs) if t]
    total, df = sum(n for *_, n in counted), Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in queries:
        found = []
        for i, c, n in counted:
            m = 100 - 25 + (25 * n * len(counted)) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(counted) + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms(text) if t in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0))
        for rank, (s, none, i) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if none else i, -s))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def tables(spark, docs, queries):
    clash = ["'a' as query", "'b' as score", "'c' as rank", "'d' as n", "'e' as item", "'f' as id", "'g' as terms", "'h' as block"]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", *clash)
    return d.repartition(3), spark.createDataFrame(queries, "item_id long, text string").selectExpr("*", *clash)


def corpus(n, seed=0):
    random.seed(seed)
    words = [f"w{i}" for i in range(300)] + ["Ähre", "ähre", "ÀB", "x_y", "3.14", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [random.choice([" ", "-", "\n"]).join(random.choices(words, weights, k=random.randint(0, 60))) for _ in range(n)]
    queries = [(i, " ".join(random.choices(words, k=random.randint(1, 120)))) for i in range(25)]
    return texts, queries


@pytest.mark.parametrize("k, size", [(1, 10**6), (5, 3000), (20, 10**6)])
def test_against_brute_force(spark, k, size):
    texts, queries = corpus(400)
    docs = list(enumerate(texts)) + [(400 + i, t) for i, t in enumerate(texts[:60])]
    docs += [(3, texts[3]), (3, texts[3]), (None, texts[5]), (None, texts[6]), (900, None), (901, ""), (902, "... !")]
    docs += [(903, "W1 w1 W1 " * 3000)]
    queries += [(100, None), (101, ""), (102, "?"), (103, "nowhere"), (104, "w1 w1 w1 w2"), (None, "w3 w4")]
    got = [tuple(r) for r in P.search(*tables(spark, docs, queries), k, query_bytes=size).collect()]
    assert order(got) == order(brute(docs, queries, k))


def test_repeated_queries_have_ranks_each(spark):
    texts, _ = corpus(30, 2)
    docs, queries = list(enumerate(texts)), [(1, "w0 w1"), (1, "w0 w1"), (1, "w2")]
    got = [tuple(r) for r in P.search(*tables(spark, docs, queries), 3).collect()]
    assert order(got) == order(brute(docs, queries, 3))


@pytest.mark.parametrize("docs, queries", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, None)]), ([], [])])
def test_empty_tables(spark, docs, queries):
    found = P.search(*tables(spark, docs, queries), 20)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_masks_that_cannot_reach_the_kth_score_are_left_out():
    rng = np.random.default_rng(5)
    n = 4000
    # Two rare terms decide; the common ones cannot lift a document over them.
    held = [sorted({*np.nonzero(rng.random(6) < [0.5, 0.5, 0.5, 0.5, 0.02, 0.02])[0].tolist()}) for _ in range(n)]
    lists = [np.array(h, dtype="<i4").tobytes() for h in held]
    tfs = [np.ones(len(h), dtype="<i4").tobytes() for h in held]
    weights = np.array([10, 10, 10, 10, 9000, 9000])
    block = P.Block(np.full(n, 50), lists, tfs, weights, n, 50 * n)
    best = P.Best(20)
    best.search(0, block, np.arange(n), np.arange(6), np.ones(6, dtype=np.int64))
    assert best.scored < 0.1 * best.grouped
    gain = int(P.gains(np.array([1]), np.array([50]), n, 50 * n)[0])
    plain = sorted((-sum(int(weights[t]) * gain for t in h), i) for i, h in enumerate(held) if h)[:20]
    assert [(-s, i) for s, i in plain] == [(int(s), int(i)) for s, i in zip(*best.found[0])]


def test_more_than_64_terms_have_whole_masks():
    n, t = 50, 130
    held = [[i % t, (i * 7 + 65) % t] for i in range(n)]
    lists = [np.array(sorted(set(h)), dtype="<i4").tobytes() for h in held]
    block = P.Block(np.full(n, 2), lists, [np.ones(len(x) // 4, dtype="<i4").tobytes() for x in lists], np.ones(t, dtype=np.int64), n, 2 * n)
    docs, group, masks = block.masks(np.arange(t))
    assert docs.tolist() == list(range(n))
    assert [np.nonzero(masks[g])[0].tolist() for g in group] == [sorted(set(h)) for h in held]
