"""Removal of repeated windows against a plain count of all of them."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from filelake.llm import bytewords
from filelake.llm import substring_dedup as S


def brute(texts, window):
    """``(kept text, words, removed)`` per text."""
    all_words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    starts = Counter(tuple(w[i : i + window]) for w in all_words for i in range(len(w) - window + 1))
    out = []
    for w in all_words:
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((" ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone)))
    return out


def run(spark, texts, window, ids=None):
    rows = [(i if ids is None else ids[i], i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, at int, text string").selectExpr(
        "*", "'a' as t1", "'b' as t2", "'c' as row", "'d' as n", "'e' as k1", "'f' as first", "'g' as repeats", "'h' as cut", "'i' as removed"
    )
    got = sorted(S.remove_repeats(df.repartition(3), window=window).collect(), key=lambda r: r["at"])
    assert all((r["doc_id"], r["text"]) == (rows[r["at"]][0], rows[r["at"]][2]) and r["t1"] == "a" and r["row"] == "c" for r in got)
    assert [r["at"] for r in got] == list(range(len(texts)))
    for r in got:
        assert r["n_removed"] == sum(s["last"] - s["first"] + 1 for s in r["removed"])
    return [(r["kept_text"], r["n_words"], r["n_removed"]) for r in got]


@pytest.mark.parametrize("window", [1, 2, 5, 9, 35])
def test_against_brute_force(spark, window):
    random.seed(window)
    few = [random.choice("abcdefghij") * random.randint(1, 3) for _ in range(12)]
    passages = [[random.choice(few) for _ in range(window + random.randint(0, 20))] for _ in range(5)]
    texts = [None, "", " \t\n\x0b\x0c\r ", "a", "x " * 200, "x y " * 100]
    for _ in range(60):
        words = [f"w{random.randint(0, 400)}" for _ in range(random.randint(0, 80))]
        for _ in range(random.randint(0, 2)):
            at = random.randint(0, len(words))
            words[at:at] = random.choice(passages)
        texts.append(random.choice([" ", "\n", " \t"]).join(words))
    texts += texts[6:9] + [texts[10] + " " + texts[10], "Ünï x \x1c é z " * 40]
    assert run(spark, texts, window) == brute(texts, window)


def test_windows_across_parts_and_blocks(spark, monkeypatch):
    random.seed(1)
    texts = [" ".join(str(random.randint(0, 10**6)) for _ in range(700)) for _ in range(6)]
    texts[3] = " ".join(texts[0].split()[100:400]) + " " + texts[3]
    texts[5] = texts[5] + " " + " ".join(texts[5].split()[600:640])
    expected = brute(texts, 35)
    assert run(spark, texts, 35) == expected
    data = pa.array([t.encode() for t in texts], pa.binary())
    whole = {}
    for (h,), rows, words, _ in S.grouped(data, 1, 35):
        at, text, number = S.whole_windows(words, 35)
        for k, r, n in zip(S.sequence_hashes(h, 35)[at].tolist(), rows[text].tolist(), number.tolist()):
            whole[r, n] = k
    monkeypatch.setattr(S, "PART", 64)
    monkeypatch.setattr(bytewords, "BYTES", 500)
    cut = {}
    for (h,), rows, words, base in S.grouped(data, 1, 35):
        assert words.tolist() == [len(h)] and len(h) <= 64 + 34
        for n, k in enumerate(S.sequence_hashes(h, 35).tolist()):
            assert (rows[0], n + base) not in cut
            cut[rows[0], n + base] = k
    assert cut == whole and len(whole) == sum(len(t.split()) - 34 for t in texts)


def test_words_are_those_of_the_pattern():
    texts = ["", " ", "a", "a b", "  \x0bä\x0c\r\nb\x1cc\x85d ", "x" * 300, "a a", "b a"]
    data, offsets = flat(texts)
    (a, b), starts, _ = bytewords.word_hashes(data, offsets)
    assert np.diff(np.searchsorted(starts, offsets)).tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]
    named = [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
    for h in (a, b):
        assert len(set(h.tolist())) == len(set(named)) and len(set(zip(named, h.tolist()))) == len(set(named))


def flat(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])])


def test_repeated_rows_and_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    texts = [text, text, "other " + text, " ".join(f"v{i}" for i in range(60))]
    assert run(spark, texts, 35, [7, 7, None, 7]) == brute(texts, 35)


def test_no_rows(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_text(spark):
    random.seed(4)
    words = [f"{random.randint(0, 10**7)}" for _ in range(600_000)]
    texts = [" ".join(words), " ".join(words[262_000:262_300]), "y " * 300_000]
    assert run(spark, texts, 35) == brute(texts, 35)


def test_estimates_are_never_too_low_and_seldom_too_high():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 1 << 63, S.KEYS, dtype=np.uint64)
    found = S.estimates(keys, np.ones(len(keys)))
    assert found.min() >= 1 and 0.005 < (found > 1).mean() < 0.05
    again = S.estimates(np.concatenate([keys, keys[:1000]]), np.ones(len(keys) + 1000))
    assert (again[:1000] >= 2).all()


def test_leaders_bound_the_windows():
    """Equal windows that start apart have the same leader at different places."""
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 4, dtype=np.uint64)[rng.integers(0, 4, 3000)]
    hashes, (key, first, last) = S.sequence_hashes(h, 9), S.leaders(h, 9)
    assert first[0] == 0 and last[-1] == len(hashes) - 1 and (first[1:] == last[:-1] + 1).all()
    places = Counter(key.tolist())
    starts = Counter(hashes.tolist())
    for k, a, b in zip(key.tolist(), first, last):
        assert places[k] >= max(starts[x] for x in hashes[a : b + 1].tolist())


def test_blocks_hand_on_a_key_once():
    block = S.Sketched(["place"])
    block.add(np.array([5, 5, 7, 5], np.uint64), np.zeros(4, np.uint64), np.arange(4))
    rows = [r for b in block.take() for r in b.to_pylist()]
    assert sorted((r["k1"], r["n"], r["place"] if r["place"] is not None else -1) for r in rows) == [(5, 0, 0), (5, 0, 1), (5, 0, 3), (5, 2, -1), (7, 1, 2)]
