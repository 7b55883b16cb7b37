"""SimHash near-duplicates: fingerprints, pigeonhole blocks, links at a small Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filelake.llm import runs, scratch
from filelake.llm.components import connected_components

WORDS = 4
DISTANCE = 4
SEED = 42
# Six blocks of the 64 bits. Four differing bits spoil at most four of them, so two stay equal: close
# fingerprints agree in at least one of the 15 pairs of blocks, about 21 bits each.
WIDTHS = (11, 11, 11, 11, 10, 10)


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """Hashes of the word shingles of a whole text, in its order; a shorter text is one shingle, none if it has no word."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(parts)
    width = min(words, len(parts))
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest, seed = xxhash.xxh64_intdigest, SEED
    spans = zip(starts[: len(parts) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.array([digest(joined[s:e], seed) for s, e in spans], dtype=np.uint64)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a whole text; zero if it has no word."""
    hashes = shingle_hashes(text, words)
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(text: Column, words: int = WORDS) -> Column:
    """``fingerprint`` of a column, as a signed 64-bit number with the same bits."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        known: dict[str | None, int] = {}
        for t in texts:
            if t not in known:
                known[t] = fingerprint(t, words)
        return pd.Series(np.array([known[t] for t in texts], dtype=np.uint64).view(np.int64))

    return of(text)


def as_hex(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def block_keys(value: Column, distance: int = DISTANCE) -> Column:
    """Array of keys: for every set of blocks that must stay equal, its number and the blocks' bits."""
    at, blocks = 0, []
    for width in WIDTHS:
        blocks.append((F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << width) - 1)), width))
        at += width
    equal = len(WIDTHS) - distance
    if equal < 1:
        raise ValueError(f"at most {len(WIDTHS) - 1} differing bits")
    keys = []
    for number, chosen in enumerate(combinations(range(len(WIDTHS)), equal)):
        key = F.lit(number).cast("long")
        for i in chosen:
            key = F.shiftleft(key, blocks[i][1]).bitwiseOR(blocks[i][0])
        keys.append(key)
    return F.array(*keys)


def _links(distance: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, end in runs.whole_runs(batches, ["key", "left", "right"]):
            bits = table.column("fp").to_numpy().view(np.uint64)
            rep = table.column("rep").to_numpy()
            label = np.arange(len(bits))
            for a, b in runs.pairs_by_distance(end):
                apart = label[a] != label[b]
                a, b = a[apart], b[apart]
                close = np.bitwise_count(bits[a] ^ bits[b]) <= distance
                if close.any():
                    label = runs.join_labels(label, a[close], b[close])
            linked = np.nonzero(label != np.arange(len(label)))[0]
            yield pa.record_batch({"u": rep[linked], "v": rep[label[linked]]})

    return of


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``(u, v)`` between ``rep`` of distinct ``(fp, rep)``: enough links to connect all close fingerprints.

    Fingerprints that share a block key meet in a task, large keys cell by cell, and are compared by
    Hamming distance. A task returns a spanning forest of the links it finds, so a group of near copies
    gives as many rows as it has members, not as many as it has pairs.
    """
    keyed = prints.select("fp", "rep", F.explode(block_keys(F.col("fp"), distance)).alias("key"))
    cells = runs.into_cells(keyed, "key", F.xxhash64("fp", F.lit(1)))
    rows = runs.sorted_runs(cells, "key").select("key", "left", "right", "fp", "rep")
    return rows.mapInArrow(_links(distance), "u long, v long")


def _groups(docs: DataFrame, id_col: str, text_col: str, words: int, distance: int) -> DataFrame:
    """``(_id, _text, fp, label, component_id)`` of every row; ``_text`` tells texts of one id apart.

    ``label`` is a fingerprint that stands for the group, so groups without any id stay apart.
    """
    prints, _ = scratch.put(
        docs.select(
            F.col(id_col).cast("long").alias("_id"),
            F.xxhash64(F.col(text_col)).alias("_text"),
            fingerprints(F.col(text_col), words).alias("fp"),
        ),
        "simhash",
    )
    least = prints.groupBy("fp").agg(F.min("_id").alias("least"))
    found = connected_components(links(least.select("fp", F.col("fp").alias("rep")), distance), "simhash-groups")
    labelled = least.join(found, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("label"))
    of_label = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    of_print = labelled.select("fp", "label").join(of_label, "label")
    return prints.join(of_print, "fp")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, distance: int = DISTANCE
) -> DataFrame:
    """One row per row of ``docs``: ``(<id_col>, fp, component_id)``.

    Texts whose fingerprints differ in at most ``distance`` bits are linked; ``component_id`` is the
    smallest id reachable, the row's own included. A null or empty text has fingerprint zero and is
    linked like any other. A row without an id links others too; its component is null if no row reachable
    has an id. Repeated rows and equal texts share a component. Rows that share an id but not a text are
    separate documents. Other columns are not read. No rows give no rows.
    """
    return _groups(docs, id_col, text_col, words, distance).select(F.col("_id").alias(id_col), "fp", "component_id")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, distance: int = DISTANCE
) -> DataFrame:
    """``docs`` without near copies: one row of each group stays, with its columns as they are.

    It is the row with the smallest id; of several texts under this id the one with the smallest hash; of
    equal rows any one. Rows without an id stay only where their group has no other; one of each group
    without any id stays.
    """
    return first_rows(docs, _groups(docs, id_col, text_col, words, distance), id_col, text_col)


def first_rows(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The first row of ``docs`` of each label of ``groups (_id, _text, label)``."""
    first = (
        groups.groupBy("label")
        .agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_text")).alias("s"))
        .select(F.coalesce(F.col("s._id").cast("string"), F.lit("")).alias("__row_id"), F.col("s._text").alias("__row_text"))
    )
    own = docs.withColumns({
        "__row_id": F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")),
        "__row_text": F.xxhash64(F.col(text_col)),
    })
    key = ["__row_id", "__row_text"]
    kept = own.join(first, key, "left_semi")
    once = kept.withColumn("__row_number", F.row_number().over(Window.partitionBy(*key).orderBy(*key)))
    return once.filter("__row_number = 1").drop(*key, "__row_number")
