"""Removal of repeated word windows: a count-min prefilter over merged partition sketches, then exact grouping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filelake.llm import bytewords, runs, scratch

WINDOW = 35
# Words of the pieces among which a window's leader is chosen.
PIECE = 8
# Window starts of a part of a long text, and rows after which a task hands on what it has counted.
PART = 1 << 18
BLOCK = 1 << 18
# Count-min sketch: rows, bits of a cell's number, and the keys that share one sketch. With half as many keys as cells
# in a row, 2 to 3 in 100 unrepeated keys are estimated as repeated, at every size of the input.
DEPTH = 4
CELL_BITS = 21
KEYS = 1 << 20
_random = np.random.default_rng(13)
ROW_FACTORS = _random.integers(0, 1 << 63, DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# Places of a leader within a part take the low bits of its order.
PLACE = np.uint64((1 << 20) - 1)


def sequence_hashes(h: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of every ``length`` consecutive entries."""
    sums, down = bytewords.running_sums(h, which)
    return bytewords.mix((sums[length:] - sums[:-length]) * down[: len(h) - length + 1])


def grouped(texts: pa.Array, hashes: int, window: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray, int]]:
    """``(hashes, rows, words, at)``: the words of some rows, how many each has, and the number of the first one in its row.

    Short texts come many at a time. A long one comes alone, in parts of at most ``PART`` window starts, so that
    every window is in just one part.
    """
    for rows, data, offsets in bytewords.groups(texts):
        if len(rows) > 1 or len(data) <= bytewords.BYTES:
            found, starts, _ = bytewords.word_hashes(data, offsets, hashes)
            yield found, rows, np.diff(np.searchsorted(starts, offsets)), 0
            continue
        made = [bytewords.word_hashes(p, np.array([0, len(p)]), hashes)[0] for p in bytewords.pieces(data)]
        found = [np.concatenate(h) for h in zip(*made)]
        for at in range(0, max(1, len(found[0]) - window + 1), PART):
            part = [h[at : at + PART + window - 1] for h in found]
            yield part, rows, np.array([len(part[0])]), at


def whole_windows(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts with so many words, one after another: each window's first word in all, its text, and its number there."""
    ends = np.cumsum(words)
    count = np.maximum(words - window + 1, 0)
    text = np.repeat(np.arange(len(words)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return number + (ends - words)[text], text, number


def leaders(h: np.ndarray, window: int = WINDOW, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(key, first, last)``: the windows ``at[first]`` to ``at[last]`` have their least piece at one place.

    The least piece of a window follows from its words, the leftmost of equal ones counts. So equal windows that
    start at two places have equal leaders at two places, and the number of a leader's places
    is never below the number of any of its windows' starts. ``at`` is all windows by default.
    """
    piece = min(PIECE, window)
    keys = sequence_hashes(h, piece)
    order = (keys & ~PLACE) | np.arange(len(keys), dtype=np.uint64)
    width, span = window - piece + 1, 1
    while span < width:
        step = min(span, width - span)
        order = np.minimum(order[:-step], order[step:])
        span += step
    place = (order & PLACE).astype(np.int64)
    place = place if at is None else place[at]
    first = np.concatenate([[0], np.nonzero(place[1:] != place[:-1])[0] + 1])
    return keys[place[first]], first, np.concatenate([first[1:], [len(place)]]) - 1


class Sketched:
    """What a task has counted of a block: keys that occur once, with their places, and keys that repeat.

    A key's count stops at 2. Places of keys that repeat within the block need no further look.
    """

    def __init__(self, names: list[str]):
        self.names, self.columns, self.rows = names, [], 0

    def add(self, *columns: np.ndarray) -> None:
        self.columns.append(columns)
        self.rows += len(columns[0])

    def take(self) -> Iterator[pa.RecordBatch]:
        """Rows ``(k1, k2, <names>, n)``: ``n`` 1 is a key with its place, 2 a repeated key, 0 a place known to repeat."""
        if not self.rows:
            return
        k1, k2, *rest = [np.concatenate(c) for c in zip(*self.columns)]
        self.columns, self.rows = [], 0
        order = np.argsort(k1)
        same = np.diff(k1[order]) == 0
        if (same & (np.diff(k2[order]) != 0)).any():
            order = np.lexsort((k2, k1))
        k1, k2, rest = k1[order], k2[order], [c[order] for c in rest]
        new = np.ones(len(k1) + 1, dtype=bool)
        new[1:-1] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        starts, once = new[:-1], new[:-1] & new[1:]
        marks = starts & ~once
        counts = np.where(once, 1, 0)
        names = ["k1", "k2", *self.names, "n"]
        own = [k1.view(np.int64), k2.view(np.int64), *rest, counts.astype(np.int32)]
        yield pa.record_batch([pa.array(c) for c in own], names)
        if marks.any():
            blank = [pa.nulls(int(marks.sum()), pa.array(c[:0]).type) for c in rest]
            twice = pa.array(np.full(int(marks.sum()), 2, dtype=np.int32))
            yield pa.record_batch([pa.array(own[0][marks]), pa.array(own[1][marks]), *blank, twice], names)


ROWS = "k1 long, k2 long, t1 long, t2 long, first int, last int, n int"
NAMES = ["t1", "t2", "first", "last"]


def _leaders_of(window: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Sketched(NAMES)
        for batch in batches:
            t1, t2 = (batch.column(n).to_numpy() for n in NAMES[:2])
            for (h,), rows, words, base in grouped(batch.column("text"), 1, window):
                at, text, number = whole_windows(words, window)
                if len(at):
                    key, first, last = leaders(h, window, at)
                    row = rows[text[first]]
                    block.add(
                        key, np.zeros(len(key), np.uint64), t1[row], t2[row],
                        (number[first] + base).astype(np.int32), (number[last] + base).astype(np.int32),
                    )
                if block.rows >= BLOCK:
                    yield from block.take()
        yield from block.take()

    return of


def estimates(keys: np.ndarray, counts: np.ndarray, bits: int = CELL_BITS) -> np.ndarray:
    """Count-min estimate of every key after adding all ``counts``: the least of its cells, never too low."""
    least = np.full(len(keys), np.iinfo(np.int64).max)
    for factor in ROW_FACTORS:
        cell = ((keys * factor) >> np.uint64(64 - bits)).astype(np.int64)
        total = np.bincount(cell, weights=counts, minlength=1 << bits)
        least = np.minimum(least, total[cell].astype(np.int64))
    return least


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places whose key is estimated as repeated: the sketches of all blocks are added, one share of the keys after another."""
    for table, end in runs.whole_runs(batches, ["share"]):
        at = 0
        while at < len(end):
            run = table.slice(at, end[at] - at)
            keys = run.column("k1").to_numpy().view(np.uint64)
            counts = run.column("n").to_numpy()
            wanted = pa.array((estimates(keys, counts) > 1) & (counts == 1))
            yield from run.filter(wanted).select(NAMES).combine_chunks().to_batches()
            at = end[at]


PLACES = "t1 long, t2 long, first int, last int"


def _suspects(docs: DataFrame, window: int) -> tuple[DataFrame, str]:
    """``(t1, t2, first, last)``: windows of texts that may start elsewhere too, and the folder of the counted rows."""
    counted, path = scratch.put(docs.mapInArrow(_leaders_of(window), ROWS), "leaders")
    # Shares are as many as keep a sketch half full; their number is known from the files.
    shares = max(1, -(-counted.count() // KEYS))
    share = F.pmod(F.xxhash64("k1"), F.lit(shares)).cast("int")
    rows = counted.filter("n > 0").select(share.alias("share"), "k1", *NAMES, "n")
    dealt = rows.repartition("share").sortWithinPartitions("share")
    found = dealt.mapInArrow(_estimated, PLACES)
    return found.union(counted.filter("n = 0").select(NAMES)), path


def _spans(places: DataFrame, name: str) -> DataFrame:
    """All spans of a text in one array of numbers: the first window in the upper 32 bits, the number of further ones below.

    With the last window below, all spans of one window would share a hash code in the set.
    """
    pair = F.shiftleft(F.col("first").cast("long"), 32).bitwiseOR((F.col("last") - F.col("first")).cast("long"))
    return places.groupBy("t1", "t2").agg(F.collect_set(pair).alias(name))


def _read_spans(packed: np.ndarray | None) -> np.ndarray:
    packed = np.zeros(0, np.int64) if packed is None else np.asarray(packed, dtype=np.int64)
    return np.stack([packed >> 32, (packed >> 32) + (packed & 0xFFFFFFFF)], axis=1)


def _covered(spans: np.ndarray, n: int, more: int = 0) -> np.ndarray:
    """Flags of the positions in any span, each longer by ``more``."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, spans[:, 0], 1)
    np.add.at(step, np.minimum(spans[:, 1] + more, n - 1) + 1, -1)
    return np.cumsum(step[:n]) > 0


def _windows_of(window: int):
    """Exact keys of the suspected windows."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Sketched(NAMES)
        for batch in batches:
            t1, t2 = (batch.column(n).to_numpy() for n in NAMES[:2])
            spans = batch.column("suspect")
            for found, rows, words, base in grouped(batch.column("text"), 2, window):
                at, text, number = whole_windows(words, window)
                if not len(at):
                    continue
                # Windows of the group that are in a span: its ends among the windows of its text.
                per_row = [_read_spans(spans[r].values.to_numpy()) for r in rows.tolist()]
                first = np.concatenate([[0], np.cumsum(np.maximum(words - window + 1, 0))])
                marked = [np.clip(p + [0, 1] - base, 0, first[i + 1] - first[i]) + first[i] for i, p in enumerate(per_row)]
                step = np.zeros(len(at) + 1, dtype=np.int64)
                edges = np.concatenate(marked)
                np.add.at(step, edges[:, 0], 1)
                np.add.at(step, edges[:, 1], -1)
                own = np.nonzero(np.cumsum(step[:-1]) > 0)[0]
                k1, k2 = (sequence_hashes(h, window, i)[at[own]] for i, h in enumerate(found))
                row, place = rows[text[own]], (number[own] + base).astype(np.int32)
                block.add(k1, k2, t1[row], t2[row], place, place)
                if block.rows >= BLOCK:
                    yield from _joined(block.take())
        yield from _joined(block.take())

    return of


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places known to repeat as spans of consecutive windows, under a key of their text."""
    for batch in batches:
        known = np.asarray(batch.column("n")) == 0
        yield batch.filter(pa.array(~known))
        if known.any():
            t1, t2, first = (batch.column(n).to_numpy(zero_copy_only=False)[known] for n in NAMES[:3])
            order = np.lexsort((first, t2, t1))
            t1, t2, first = t1[order], t2[order], first[order]
            new = np.concatenate([[True], (t1[1:] != t1[:-1]) | (t2[1:] != t2[:-1]) | (first[1:] > first[:-1] + 1)])
            starts = np.nonzero(new)[0]
            ends = np.concatenate([starts[1:], [len(first)]]) - 1
            own = [t1[starts], t2[starts], t1[starts], t2[starts], first[starts], first[ends], np.zeros(len(starts), np.int32)]
            yield pa.record_batch([pa.array(c) for c in own], batch.schema.names)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of keys with two rows or a mark, and the spans known before."""
    for table, end in runs.whole_runs(batches, ["k1", "k2"]):
        counts = table.column("n").to_numpy()
        starts = np.nonzero(np.concatenate([[True], end[1:] != end[:-1]]))[0]
        total = np.add.reduceat(counts.astype(np.int64), starts)
        per_row = np.repeat(total, np.diff(np.concatenate([starts, [len(end)]])))
        wanted = pa.array((counts == 0) | ((counts == 1) & (per_row > 1)))
        yield from table.filter(wanted).select(NAMES).combine_chunks().to_batches()


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(t1, t2, repeats)`` of ``docs (text, t1, t2)``: per text the windows that start elsewhere too, as spans."""
    suspects, path = _suspects(docs, window)
    marked, marked_path = scratch.put(_spans(suspects, "suspect"), "suspects")
    scratch.drop(docs.sparkSession, path)
    again = docs.join(marked, ["t1", "t2"]).select("text", "t1", "t2", "suspect")
    keyed = again.mapInArrow(_windows_of(window), ROWS).repartition("k1", "k2").sortWithinPartitions("k1", "k2")
    found, _ = scratch.put(_spans(keyed.mapInArrow(_repeated, PLACES), "repeats"), "repeats")
    scratch.drop(docs.sparkSession, marked_path)
    return found


def _cut(window: int):
    schema = "kept_text string, n_words long, n_removed long, removed array<struct<first: long, last: long>>"

    @F.pandas_udf(schema)
    def of(texts: pd.Series, repeats: pd.Series) -> pd.DataFrame:
        rows = []
        for text, packed in zip(texts, repeats):
            words = text.encode("utf-8", "surrogatepass").split() if text else []
            n = len(words)
            if packed is None:
                rows.append((b" ".join(words).decode("utf-8", "surrogatepass"), n, 0, []))
                continue
            gone = _covered(_read_spans(packed), n, window - 1)
            edges = np.nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))[0].reshape(-1, 2)
            kept = b" ".join([words[i] for i in np.nonzero(~gone)[0]])
            spans = [{"first": int(a), "last": int(b) - 1} for a, b in edges]
            rows.append((kept.decode("utf-8", "surrogatepass"), n, int(gone.sum()), spans))
        return pd.DataFrame(rows, columns=["kept_text", "n_words", "n_removed", "removed"])

    return of


def remove_repeats(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with ``kept_text, n_words, n_removed`` and ``removed``, the spans of words that go.

    A word goes if a window of ``window`` consecutive words covers it whose word sequence also starts elsewhere,
    in any document or the same one. Words are what stands between ASCII white space, unchanged; kept
    words are joined by one space. Windows are judged on the input. A null or empty text and one with fewer words
    than a window lose nothing (``kept_text`` is empty for null). Repeated rows count as documents each,
    whatever their ids, so a row that occurs twice loses all its windows. No rows give no rows. Other columns are
    kept; input columns with the names of the new ones are replaced.

    Windows are counted under their leader, one piece of ``PIECE`` words; a leader's places are some 14 times fewer
    than windows. Tasks count leaders by blocks; the sketches of all blocks are added in shares of bounded size, and
    only windows whose leader is estimated at 2 or more are grouped, by 128 bits of their words.
    Nothing is broadcast, and a hot key leaves each block as one row.
    """
    new = ("kept_text", "n_words", "n_removed", "removed")
    # Equal texts have equal windows, so a text is named by 128 bits of itself.
    named = docs.select(
        F.struct(*[c for c in docs.columns if c not in new]).alias("row"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.col(text_col)).alias("t1"),
        F.xxhash64(F.lit("text"), F.col(text_col)).alias("t2"),
    )
    found = repeated_windows(named.select("text", "t1", "t2").filter("text is not null"), window)
    cut = named.join(found, ["t1", "t2"], "left").select("row", _cut(window)(F.col("text"), F.col("repeats")).alias("cut"))
    return cut.select("row.*", "cut.*")
