import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from filelake.llm import simhash
from filelake.llm.components import connected_components


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows, distance=4):
    """Smallest id reachable from each row, by comparing all pairs."""
    prints = [brute_print(t) for _, t in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (prints[a] ^ prints[b]).bit_count() <= distance and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    least = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [(i, prints[n], least.get(group[n])) for n, (i, _) in enumerate(rows)]


def rows_of(n=60, seed=1):
    random.seed(seed)
    vocabulary = ["wörd%d" % i for i in range(300)]
    rows = []
    for i in range(n):
        words = random.choices(vocabulary, k=random.choice([1, 3, 4, 40, 400]))
        rows.append((i, " ".join(words)))
        if i % 3 == 0:
            for j in range(random.randint(1, 4)):
                words[random.randrange(len(words))] = "other"
                rows.append((1000 + 10 * i + j, " \t".join(words).upper() if i % 2 else "\n".join(words)))
    return rows + [(5000, None), (5001, ""), (5002, " \n"), (5003, rows[0][1]), (5003, rows[0][1]), (None, rows[3][1]), (None, "lone text here now")]


def test_fingerprint_is_the_bit_majority():
    for text in [None, "", "One", "a b c", "A b\tC d", "é " * 50, *[t for _, t in rows_of(12)]]:
        assert simhash.fingerprint(text) == brute_print(text)


def test_groups_equal_all_pairs(docs):
    rows = rows_of()
    found = simhash.near_duplicates(docs(rows)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    ours = sorted([(r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in found], key=key)
    assert ours == sorted(brute_groups(rows), key=key)


def test_hot_block_is_cut_into_cells(spark, monkeypatch):
    """Many fingerprints share all their blocks but one; cells of 16 lose no link."""
    random.seed(3)
    values = {random.getrandbits(9) << 50 for _ in range(300)} | {random.getrandbits(64) for _ in range(100)}
    values = sorted(values)
    monkeypatch.setattr(simhash.runs.into_cells, "__defaults__", (16,))
    signed = [int(np.array([v], dtype=np.uint64).view(np.int64)[0]) for v in values]
    prints = spark.createDataFrame([(v, n) for n, v in enumerate(signed)], "fp long, rep long")
    found = {r["node"]: r["component"] for r in connected_components(simhash.links(prints)).collect()}
    group = list(range(len(values)))
    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= 4 and group[a] != group[b]:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    assert [found.get(n, n) for n in range(len(values))] == group


def test_keep_one(docs):
    rows = rows_of()
    kept = simhash.keep_one(docs(rows))
    assert kept.columns == docs(rows).columns
    groups = {(i, t): c for (i, t), (_, _, c) in zip(rows, brute_groups(rows))}
    wanted = sorted({(i, t) for (i, t), c in groups.items() if i is not None and i == c}, key=str)
    got = sorted([(r["doc_id"], r["text"]) for r in kept.collect()], key=str)
    assert [g for g in got if g[0] is not None] == wanted
    assert [g for g in got if g[0] is None] == [(None, "lone text here now")]


def test_rows_without_an_id_stay_and_link(docs, monkeypatch):
    # Fingerprints given by hand: 0 - 15 - 255 is a chain through a row without an id; 1 << 40 and -1 stand alone.
    values = {"a": 0, "b": 15, "c": 255, "d": (1 << 40) - 1 << 20, "e": (1 << 64) - 1}
    rows = [(1, "a"), (None, "b"), (2, "c"), (None, "d"), (None, "e"), (None, "e")]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    by_text = [(t, signed(v)) for t, v in values.items()]
    monkeypatch.setattr(simhash, "fingerprints", lambda text, words: F.create_map(*[F.lit(x) for p in by_text for x in p])[text].cast("long"))
    found = {(r["doc_id"], r["fp"]): r["component_id"] for r in simhash.near_duplicates(docs(rows)).collect()}
    assert found == {(1, 0): 1, (None, 15): 1, (2, 255): 1, (None, signed(values["d"])): None, (None, -1): None}
    kept = sorted([(r["doc_id"], r["text"]) for r in simhash.keep_one(docs(rows)).collect()], key=str)
    assert kept == sorted([(1, "a"), (None, "d"), (None, "e")], key=str)


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    assert simhash.keep_one(docs([])).count() == 0


def test_components_of_a_long_path(spark):
    path = [(i, i + 1) for i in range(200)] + [(300, 301), (301, 300), (7, 7), (None, 4)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(path, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(201)}, 300: 300, 301: 300}
