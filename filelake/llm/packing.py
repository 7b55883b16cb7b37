"""Packing of documents into sequences of a fixed number of tokens: best fit, then swaps between bins."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filelake.llm import bytewords, scratch

CAPACITY = 4096
# Pieces that are packed together in one task, and the groups whose open bins meet in the next round.
GROUP = 4096
FAN_IN = 16
# Emptiest bins a group passes on to the next round.
OPEN_BINS = 48
# Rounds of swaps over the open bins of a group, and how many of the emptiest are tried as giver.
SWAP_ROUNDS = 200
GIVERS = 16
# Distinct chunks whose token ids a worker remembers, and how many new ones it keeps aside before it merges them.
REMEMBERED = 1_000_000
ASIDE = 1 << 16

# What may follow a word of letters whose ids do not change by it.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
PLAIN_WORD = re.compile(r"[a-zß-öø-ÿ]+")


@dataclass
class Known:
    """Chunks by their two hashes in the order of the first, with the place of their ids; ``used`` since it was made."""

    k1: np.ndarray
    k2: np.ndarray
    start: np.ndarray
    size: np.ndarray
    used: np.ndarray

    @staticmethod
    def of(k1: np.ndarray, k2: np.ndarray, start: np.ndarray, size: np.ndarray) -> Known:
        order = np.argsort(k1)
        return Known(k1[order], k2[order], start[order], size[order], np.zeros(len(k1), dtype=bool))

    def find(self, k1: np.ndarray, k2: np.ndarray, mark: bool = True) -> np.ndarray:
        """Rows of chunks, -1 for those not here and -2 where another chunk has the same first hash."""
        if not len(self.k1):
            return np.full(len(k1), -1)
        at = np.minimum(np.searchsorted(self.k1, k1), len(self.k1) - 1)
        same = self.k1[at] == k1
        here = same & (self.k2[at] == k2)
        if mark:
            self.used[at[here]] = True
        return np.where(here, at, np.where(same, -2, -1))


NOTHING = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)


def _joined(arrays: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, dtype=kind)


def _gather(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Slices of ``ids`` one after another."""
    before = np.cumsum(size) - size
    return ids[np.repeat(start - before, size) + np.arange(int(size.sum()))]


class TokenIds:
    """Token ids of whole texts, remembering those of the chunks between white space that were seen before.

    A tokenizer that works on words gives a text the ids of its words one after another, so only new chunks
    reach it. Chunks are told apart by 128 bits of themselves and looked up many at a time; where the first 64 bits are
    not enough, a text is encoded whole. A full memory keeps the chunks that were used again.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.word_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.word_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known, self.aside = Known.of(*NOTHING), Known.of(*NOTHING)
        self.ids = np.zeros(1 << 20, dtype="<u4")
        self.filled = 0

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters only, and how many each has. They are encoded many at a time: some ids end a word."""
        found, sizes = [], []
        for i in range(0, len(words), 256):
            part = words[i : i + 256]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.nonzero(self.word_end[ids])[0] + 1
            if len(ends) != len(part):
                each = [self._whole(w) for w in part]
                ids, ends = np.concatenate(each), np.cumsum([len(e) for e in each])
            found.append(ids)
            sizes.append(np.diff(ends, prepend=0))
        return _joined(found, "<u4"), _joined(sizes, np.int64)

    def _new(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, each alone, and how many each has: those of a word and the marks after it, or of the whole chunk."""
        cores = [c.rstrip(MARKS) for c in chunks]
        words = [w if PLAIN_WORD.fullmatch(w) else "" for w in map(str.lower, cores)]
        # What the ids of a chunk are made of: nothing, words, then marks and whole chunks by their text.
        number = {w: i for i, w in enumerate(dict.fromkeys(["", *words]))}
        ids, sizes = self._words(list(number)[1:])
        rest = [c[len(core) :] if w else c for c, core, w in zip(chunks, cores, words)]
        other = {r: i for i, r in enumerate(dict.fromkeys(rest), len(number))}
        whole = [self._whole(r) for r in other]
        pool = np.concatenate([ids, _joined(whole, "<u4")])
        sizes = np.concatenate([[0], sizes, [len(w) for w in whole]]).astype(np.int64)
        parts = np.array([[number[w], other[r]] for w, r in zip(words, rest)], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        return _gather(pool, starts[parts].ravel(), sizes[parts].ravel()), sizes[parts].sum(axis=1)

    def _add(self, k1: np.ndarray, k2: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        old = self.aside
        start = self._store(ids, size)
        both = [np.concatenate(x) for x in zip((old.k1, old.k2, old.start, old.size), (k1, k2, start, size))]
        used = np.concatenate([old.used, np.zeros(len(k1), dtype=bool)])
        order = np.argsort(both[0])
        self.aside = Known(*(x[order] for x in both), used[order])

    def _store(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        while self.filled + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.filled : self.filled + len(ids)] = ids
        start = np.cumsum(size) - size + self.filled
        self.filled += len(ids)
        return start

    def _make_room(self) -> None:
        """Merge the chunks kept aside; if there are too many, keep those used again, or none if that are most."""
        if len(self.aside.k1) <= ASIDE:
            return
        names = ("k1", "k2", "start", "size", "used")
        k1, k2, start, size, used = (np.concatenate([getattr(self.known, n), getattr(self.aside, n)]) for n in names)
        self.aside = Known.of(*NOTHING)
        order = np.argsort(k1)
        if len(k1) > REMEMBERED:
            order = order[used[order]] if used.mean() < 0.75 else order[:0]
            used = np.zeros_like(used)
        self.known = Known(k1[order], k2[order], start[order], size[order], used[order])
        if len(order) < len(k1):
            kept, self.ids, self.filled = _gather(self.ids, start[order], size[order]), np.zeros(1 << 20, dtype="<u4"), 0
            self.known.start = self._store(kept, self.known.size)

    def _piece(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of the texts that stand in ``data`` one after another."""
        (k1, k2), begin, end = bytewords.word_hashes(data, offsets)
        own1, first, word = np.unique(k1, return_index=True, return_inverse=True)
        own2 = k2[first]
        if (own2[word] != k2).any():
            return [self._whole(data[a:b].tobytes().decode()) for a, b in zip(offsets[:-1], offsets[1:])]
        self._make_room()
        at, aside = self.known.find(own1, own2), self.aside.find(own1, own2)
        if (at == -2).any() or (aside == -2).any():
            return [self._whole(data[a:b].tobytes().decode()) for a, b in zip(offsets[:-1], offsets[1:])]
        new = np.nonzero((at < 0) & (aside < 0))[0]
        if len(new):
            raw = data.tobytes()
            places = zip(begin[first[new]].tolist(), end[first[new]].tolist())
            self._add(own1[new], own2[new], *self._new([raw[a:b].decode("utf-8", "replace") for a, b in places]))
            aside = self.aside.find(own1, own2, mark=False)
        start, size = np.zeros(len(own1), np.int64), np.zeros(len(own1), np.int64)
        for level, rows in ((self.known, at), (self.aside, aside)):
            here = rows >= 0
            start[here], size[here] = level.start[rows[here]], level.size[rows[here]]
        ids = _gather(self.ids, start[word], size[word])
        ends = np.concatenate([[0], np.cumsum(size[word])])[np.searchsorted(begin, offsets)]
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for rows, data, offsets in bytewords.groups(texts):
            if len(rows) > 1 or len(data) <= bytewords.BYTES:
                yield from self._piece(data, offsets)
            else:
                yield np.concatenate([self._piece(p, np.array([0, len(p)]))[0] for p in bytewords.pieces(data)])


_TOKEN_IDS: dict[str, TokenIds] = {}


def _cut(path: str, end_id: int, capacity: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _TOKEN_IDS:
            _TOKEN_IDS[path] = TokenIds(path)
        encode = _TOKEN_IDS[path]
        for batch in batches:
            out: list[tuple] = []
            for key, found in zip(batch.column("id").to_pylist(), encode(batch.column("text"))):
                ids = found.tobytes() + end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[start : start + 4 * capacity]
                    out.append((key, piece, start // 4, len(own) // 4, zlib.crc32(own)))
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                yield pa.record_batch(columns, ["id", "piece", "start", "length", "ids_crc32"])

    return of


def pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = CAPACITY
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32)``: documents as token ids with ``end_id``, cut where longer than ``capacity``.

    ``tokenizer`` is the path of a tokenizer file that all executors have.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_cut(tokenizer, end_id, capacity), "id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of item numbers: longest items first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect_left(room, (lengths[item], -1))
        if at == len(room):
            left, b = capacity, len(bins)
            bins.append([])
        else:
            left, b = room.pop(at)
        bins[b].append(item)
        if left > lengths[item]:
            insort(room, (left - lengths[item], b))
    return bins


def swap(bins: list[list[int]], lengths: list[int], capacity: int = CAPACITY, rounds: int = SWAP_ROUNDS) -> list[list[int]]:
    """Fewer bins by local search: moves and one-for-one and two-for-one exchanges that increase squared fill.

    One of the emptiest bins gives to fuller ones: an item where there is room, a larger item for a smaller one,
    or two items for one. Filling the fuller bin further increases the sum of squared fills. A bin that
    has given everything is gone; the search ends at the least possible number of bins or when no change is left.
    """
    fill = [sum(lengths[i] for i in b) for b in bins]
    least = -(-sum(fill) // capacity)
    full = [b for b, f in zip(bins, fill) if f == capacity]
    open_ = sorted(((f, b) for b, f in zip(bins, fill) if f < capacity), key=lambda x: x[0])
    for _ in range(rounds):
        if len(full) + len(open_) <= least:
            break
        for giver in range(min(GIVERS, len(open_) - 1)):
            given, source = open_[giver]
            source = sorted(source, key=lambda i: -lengths[i])
            fuller = open_[giver + 1 :]
            changed = False
            for n in range(len(fuller) - 1, -1, -1):
                f, target = fuller[n]
                best = _best_change(source, target, lengths, capacity - f) if source else None
                if best is None:
                    continue
                out, back = best
                gain = sum(lengths[i] for i in out)
                source = [i for i in source if i not in out]
                if back is not None:
                    gain -= lengths[back]
                    target = [i for i in target if i != back]
                    source.append(back)
                fuller[n] = (f + gain, [*target, *out])
                given -= gain
                changed = True
            if changed:
                full += [b for f, b in fuller if f == capacity]
                left = [(given, source)] if source else []
                open_ = sorted([*open_[:giver], *left, *(x for x in fuller if x[0] < capacity)], key=lambda x: x[0])
                break
        else:
            break
    return full + [b for _, b in open_]


def _best_change(source: list[int], target: list[int], lengths: list[int], room: int) -> tuple[list[int], int | None] | None:
    """The change that fills the target's room most: ``(items to it, item back)``."""
    sizes = sorted((lengths[i], i) for i in source)
    best, gain = None, 0

    def largest(limit: int) -> tuple[int, int] | None:
        at = bisect_left(sizes, (limit + 1, -1))
        return sizes[at - 1] if at else None

    if (move := largest(room)) and move[0] > gain:
        best, gain = ([move[1]], None), move[0]
    for back in target:
        limit = room + lengths[back]
        if gain == room:
            break
        if (one := largest(limit)) and one[0] - lengths[back] > gain:
            best, gain = ([one[1]], back), one[0] - lengths[back]
        low, high = 0, len(sizes) - 1
        while low < high and gain < room:
            both = sizes[low][0] + sizes[high][0]
            if both > limit:
                high -= 1
                continue
            if both - lengths[back] > gain:
                best, gain = ([sizes[low][1], sizes[high][1]], back), both - lengths[back]
            low += 1
    return best


def _pack_group(group: pd.DataFrame, level: int, number: int, open_bins: int, capacity: int) -> pd.DataFrame:
    """Sequence and offset of the rows of one group; ``done`` is false in the bins it passes on."""
    group = group.sort_values(["length", "id", "piece", "ids_crc32"], ascending=[False, True, True, True], na_position="last")
    lengths = group["length"].tolist()
    bins = swap(best_fit(lengths, capacity), lengths, capacity)
    fill = [sum(lengths[i] for i in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: (fill[b], b))
    passed = {b for b in order[:open_bins] if fill[b] < capacity}
    sequence, offset = np.zeros(len(group), dtype=np.int64), np.zeros(len(group), dtype=np.int64)
    done = np.ones(len(group), dtype=bool)
    for b, items in enumerate(bins):
        at = 0
        for i in items:
            sequence[i] = (level << 56) | (number << 24) | b
            offset[i] = at
            done[i] = b not in passed
            at += lengths[i]
    return group.assign(sequence_id=sequence, offset=offset, done=done)


PACKED = "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _pack(level: int, open_bins: int, capacity: int):
    def of(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        packed = _pack_group(group, level, int(key[0]), open_bins, capacity)
        return packed[["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "done"]]

    return of


def pack(cut: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``cut`` (see ``pieces``) with ``sequence_id`` and ``offset``.

    Full pieces are sequences of their own. The rest is dealt by hash into groups of about ``group``
    pieces; each is packed best fit and improved by swaps. A group keeps its full and nearly full bins and
    passes its emptiest ones on; ``FAN_IN`` groups' passed bins are packed together in the next round, until one
    group is left. A group holds a bounded number of pieces in every round, however large the input is.
    """
    spark = cut.sparkSession
    staged, _ = scratch.put(cut, "pieces")
    whole = staged.filter(F.col("length") == capacity).select(
        "*",
        F.monotonically_increasing_id().bitwiseOR(F.lit(1 << 62)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    left = staged.filter(F.col("length") < capacity)
    groups = max(1, -(-left.count() // group))
    result, level = whole, 0
    number = F.pmod(F.xxhash64("id", "piece", "ids_crc32", F.rand(7)), F.lit(groups))
    rest = left.withColumn("group", number)
    while True:
        last = groups == 1
        packed, _ = scratch.put(
            rest.groupBy("group").applyInPandas(_pack(level, 0 if last else OPEN_BINS, capacity), PACKED + ", done boolean"),
            "packed",
        )
        result = result.union(packed.filter("done").drop("done"))
        if last:
            return result
        level += 1
        # The number of the group is in the sequence id.
        group_of = F.shiftright("sequence_id", 24).bitwiseAND(F.lit((1 << 32) - 1))
        groups = -(-groups // FAN_IN)
        rest = packed.filter("not done").withColumn("group", F.pmod(group_of, F.lit(groups))).drop("sequence_id", "offset", "done")


def pack_documents(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece: ``(<id_col>, piece, start, length, ids_crc32, sequence_id, offset)``.

    A document is its token ids and ``end_id``; only longer ones than ``capacity`` are cut. Pieces of a
    sequence are gapless from offset 0 and at most ``capacity`` tokens together. A null or empty text is the
    end id alone. Null ids are kept as null; repeated rows are packed once each; no rows give no
    sequences. Other columns are not read. ``sequence_id`` is any number.
    """
    cut = pieces(docs, tokenizer, id_col, text_col, end_id, capacity)
    return pack(cut, capacity).withColumnRenamed("id", id_col)
