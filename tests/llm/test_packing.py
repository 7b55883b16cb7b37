import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from filelake.llm import bytewords, packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "it's I'll DON'T a<|endoftext|>b", "\x1c a\x1db \x85 c", "ÀÉ Straße İstanbul ΟΔΟΣ ﬁ e\u0301 x", "--a--b--",
    "''s'", "x\u00adz ½ ² 12,3.4 日本 語", "A, b! C?? \u2003 d", "\u0301 a", "word" * 3000,
]


def texts(n=30, seed=1):
    random.seed(seed)
    words = ["".join(random.choices("abcdeéßñ'.,!%1", k=random.randint(1, 9))) for _ in range(200)]
    return [" ".join(random.choices(words, k=random.choice([1, 30, 300, 6000]))) for _ in range(n)]


def test_ids_are_those_of_the_tokenizer():
    plain, ours = Tokenizer.from_file(PATH), packing.TokenIds(PATH)
    every = [t or "" for t in ODD] + texts()
    for text, ids in zip(every, ours(pa.array(every))):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 60)
    monkeypatch.setattr(packing, "ASIDE", 10)
    monkeypatch.setattr(bytewords, "BYTES", 2000)
    plain, ours = Tokenizer.from_file(PATH), packing.TokenIds(PATH)
    some = texts(8, 2) + texts(8, 3) + texts(8, 2)
    for text, ids in zip(some, ours(pa.array(some))):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(ours.known.k1) <= 60 + 10 + 200


def test_chunks_that_share_half_their_hash(monkeypatch):
    real = bytewords.word_hashes

    def half(data, offsets, hashes=2):
        (a, b), begin, end = real(data, offsets)
        return [a % np.uint64(7), b], begin, end

    monkeypatch.setattr(bytewords, "word_hashes", half)
    plain, ours = Tokenizer.from_file(PATH), packing.TokenIds(PATH)
    for _ in range(2):
        for text, ids in zip(texts(5), ours(pa.array(texts(5)))):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
        for word in ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten"):
            assert [i.tolist() for i in ours(pa.array([word]))] == [plain.encode(word, add_special_tokens=False).ids]


def check_packing(rows, sequences_of, capacity):
    """Round trip: pieces make up their documents, and sequences are gapless and not too long."""
    plain = Tokenizer.from_file(PATH)
    wanted = {}
    for i, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = np.array(ids[start : start + capacity], dtype="<u4").tobytes()
            key = (i, piece, start, len(own) // 4, zlib.crc32(own))
            wanted[key] = wanted.get(key, 0) + 1
    got, sequences = {}, {}
    for r in sequences_of:
        key = (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
        got[key] = got.get(key, 0) + 1
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == wanted
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(k[3] * n for k, n in wanted.items())


def test_documents_round_trip(docs):
    rows = [(i, t) for i, t in enumerate(ODD + texts())] + [(3, ODD[3])] * 3 + [(None, "no id"), (None, "no id")]
    n, total = check_packing(rows, packing.pack_documents(docs(rows), PATH).collect(), 4096)
    assert n == -(-total // 4096)


def test_many_groups_and_rounds(docs, monkeypatch):
    monkeypatch.setattr(packing.pack, "__defaults__", (4096, 8))
    monkeypatch.setattr(packing, "FAN_IN", 2)
    rows = [(i, " ".join(["word"] * (1 + i * 37 % 90))) for i in range(150)]
    n, total = check_packing(rows, packing.pack_documents(docs(rows), PATH, capacity=100).collect(), 100)
    assert n <= 1.15 * total / 100


def test_empty_table(docs):
    assert packing.pack_documents(docs([]), PATH).count() == 0


def squares(bins, lengths):
    return sum(sum(lengths[i] for i in b) ** 2 for b in bins)


def test_swaps_keep_items_and_only_improve():
    random.seed(5)
    for _ in range(50):
        lengths = [random.randint(1, 60) for _ in range(random.randint(1, 80))]
        first = packing.best_fit(lengths, 100)
        # A worse start leaves more to mend.
        order = list(range(len(lengths)))
        random.shuffle(order)
        loose, fill = [[]], 0
        for i in order:
            if fill + lengths[i] > 100:
                loose.append([])
                fill = 0
            loose[-1].append(i)
            fill += lengths[i]
        for bins in (first, loose):
            better = packing.swap([list(b) for b in bins], lengths, 100)
            assert sorted(i for b in better for i in b) == list(range(len(lengths)))
            assert all(sum(lengths[i] for i in b) <= 100 for b in better)
            assert len(better) <= len(bins) and squares(better, lengths) >= squares(bins, lengths)


def test_swaps_empty_bins():
    # One-for-one and two-for-one exchanges are needed here: best fit leaves three bins.
    lengths = [60, 30, 55, 25, 20, 10]
    assert len(packing.swap([[0, 1], [2, 3], [4, 5]], lengths, 100)) == 2
