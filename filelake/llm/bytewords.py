"""Words of many texts at once: where they are in the bytes of the texts, and hashes of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are looked at together.
BYTES = 1 << 20
_random = np.random.default_rng(12)
FACTORS = _random.integers(0, 1 << 63, 6, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# A random number for each byte, once for each of the two hashes of a word.
BYTE_VALUES = _random.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# White space between words.
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * FACTORS[2]
    x = (x ^ (x >> np.uint64(29))) * FACTORS[3]
    return x ^ (x >> np.uint64(32))


def _powers(factor: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    inverse = np.uint64(pow(int(factor), -1, 1 << 64))
    both = []
    for base in (factor, inverse):
        steps = np.full(n, base, dtype=np.uint64)
        steps[:1] = 1
        both.append(np.cumprod(steps, dtype=np.uint64))
    return both[0], both[1]


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def running_sums(values: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of a polynomial's terms, and the factors that make a difference of two of them start at power 0."""
    n = len(values)
    if n > len(_POWERS.get(which, ((),))[0]):
        _POWERS[which] = _powers(FACTORS[which], max(n, BYTES + 1))
    up, down = _POWERS[which]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * up[:n], dtype=np.uint64, out=sums[1:])
    return sums, down[:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray, hashes: int = 2) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """``hashes`` 64-bit hashes of every word of texts that stand one after another, and the words' starts and ends."""
    space = SPACE[data]
    edge = np.ones(len(data) + 1, dtype=bool)
    edge[1:-1] = space[1:] | space[:-1]
    edge[offsets] = True
    cuts = np.nonzero(edge)[0]
    own = ~space[cuts[:-1]] if len(cuts) > 1 else np.zeros(0, dtype=bool)
    starts, ends = cuts[:-1][own], cuts[1:][own]
    out = []
    for which in range(hashes):
        sums, down = running_sums(BYTE_VALUES[which][data], which)
        out.append(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * FACTORS[4 + which]))
    return out, starts, ends


def pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text cut at white space into pieces of about ``BYTES``."""
    at = 0
    while at < len(data):
        upto = at + BYTES
        while upto < len(data) and not SPACE[data[upto]]:
            near = np.nonzero(SPACE[data[upto : upto + BYTES]])[0]
            upto = upto + int(near[0]) if len(near) else upto + BYTES
        yield data[at:upto]
        at = upto


def groups(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(rows, data, offsets)``: rows whose texts have up to ``BYTES`` together, or one longer text alone."""
    texts = texts.cast(pa.binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    row = 0
    while row < len(texts):
        upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BYTES, side="right")) - 1)
        yield np.arange(row, upto), data[offsets[row] : offsets[upto]], offsets[row : upto + 1] - offsets[row]
        row = upto
