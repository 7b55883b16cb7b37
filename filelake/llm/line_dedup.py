"""Line dedup: a suffix array over line numbers by prefix doubling, and its intervals of repeated runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filelake.llm import scratch

# Words a repeated run of lines needs before its later copies are deleted.
MIN_WORDS = 50
# Line ends, but for those before a blank line: blank lines stay with the line above them.
LINE_END = r"\n(?![^\S\n]*(?:\n|\z))"
SPACE = " \t\r\n\u000b\f"
KEY = ["_id", "_text"]


def _words(line: Column) -> Column:
    """Words of a trimmed line, counted by its spaces."""
    return (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1).cast("int")


def _lines(docs: DataFrame) -> DataFrame:
    """``(_id, _text, i, words, line)`` of all lines with a word; ``line`` is a digest of the trimmed line."""
    trimmed = F.btrim(F.col("col"), F.lit(SPACE))
    exploded = docs.select(*KEY, F.posexplode(F.split("_whole", LINE_END, -1)).alias("i", "col"))
    return exploded.select(*KEY, "i", trimmed.alias("t")).filter("t != ''").select(
        *KEY, "i", _words(F.col("t")).alias("words"), F.unhex(F.md5("t")).alias("line")
    )


def _ranked(keys: DataFrame, by: list[str], name: str) -> DataFrame:
    """Repeated ``keys`` with their rank in sorted order; those that occur once have no copy and go."""
    repeated = keys.groupBy(*by).count().filter("count > 1").select(*by)
    # A sort over ranges: numbers grow from partition to partition and within each.
    return repeated.orderBy(*by).withColumn(name, F.monotonically_increasing_id())


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """``(_id, _text, s, h)``: shortest runs of repeated lines with ``min_words``, from and up to each line.

    A repeated run of enough words is the union of those that lie in it: a line is in the shortest run
    from it, or in the one up to it, or both ends are so near that the run from the first line holds it.
    Equal runs have equal lengths, so their copies meet under one key.
    """
    by_doc = Window.partitionBy(*KEY).orderBy("i")
    rows = lines.withColumn("seg", F.col("i") - F.row_number().over(by_doc))
    seg = [*KEY, "seg"]
    in_seg = Window.partitionBy(*seg).orderBy("i")
    rows = rows.withColumns({
        "end": F.sum("words").over(in_seg.rowsBetween(Window.unboundedPreceding, 0)),
        "total": F.sum("words").over(Window.partitionBy(*seg)),
    }).withColumn("start", F.col("end") - F.col("words"))
    # Every line has a word, so a frame over the words holds fewer than min_words lines.
    after = Window.partitionBy(*seg).orderBy("start").rangeBetween(1, min_words - 1)
    before = Window.partitionBy(*seg).orderBy("end").rangeBetween(1 - min_words, -1)
    rows = rows.withColumns({
        "ahead": F.when(F.col("total") - F.col("start") >= min_words, F.count("*").over(after) + 1),
        "back": F.when(F.col("end") >= min_words, F.count("*").over(before) + 1),
    })
    spans = F.array(
        F.struct(F.col("i").alias("s"), F.col("ahead").cast("int").alias("h")),
        F.struct((F.col("i") - F.col("back") + 1).cast("int").alias("s"), F.col("back").cast("int").alias("h")),
    )
    runs = rows.select(*KEY, F.explode(F.array_distinct(spans)).alias("x")).select(*KEY, "x.s", "x.h")
    return runs.filter("h is not null").distinct()


def _later_copies(intervals: DataFrame) -> DataFrame:
    """Runs of an interval of the suffix array other than its first in the order of documents."""
    by = ["h", "a", "b"]
    place = F.struct(*KEY, "s")
    first = intervals.groupBy(*by).agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    return intervals.join(first, by).filter(place != F.col("first")).select(*KEY, "s", "h")


def _merged(found: DataFrame) -> DataFrame:
    """``(_id, _text, spans)``: the lines of all runs ``(s, h)`` as disjoint spans ``(s, e)`` in order."""
    runs = found.select(*KEY, "s", (F.col("s") + F.col("h") - 1).alias("e")).repartition(*KEY)
    by_doc = Window.partitionBy(*KEY).orderBy("s", "e")
    reached = F.max("e").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.withColumn("new", (F.coalesce(reached, F.lit(-2)) < F.col("s") - 1).cast("int"))
    islands = starts.withColumn("island", F.sum("new").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    spans = islands.groupBy(*KEY, "island").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    return spans.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("spans"))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(_id, _text, spans)`` of ``docs (_id, _text, _whole)``: the lines to delete as disjoint ``(s, e)``."""
    spark = docs.sparkSession
    lines, lines_path = scratch.put(_lines(docs), "lines")
    names = _ranked(lines, ["line"], "rank")
    ranked = lines.join(names, "line").select(*KEY, "i", "words", "rank")
    # Rows that repeat id and text are one document.
    ranked, _ = scratch.put(ranked.repartition(*KEY).dropDuplicates([*KEY, "i"]), "ranks")
    scratch.drop(spark, lines_path)
    windows, _ = scratch.put(_windows(ranked, min_words), "windows")
    longest = windows.agg(F.max("h")).first()[0] or 1

    ranks, ranks_path, found, size = ranked.select(*KEY, "i", "rank"), None, None, 1
    while True:
        # The suffixes whose first h lines are equal are an interval of the suffix array. Two ranks of
        # prefixes of `size` lines name it: from its first line, and so that it ends with its last.
        here = windows.filter((F.col("h") >= size) & (F.col("h") < 2 * size))
        head = ranks.select(*KEY, F.col("i").alias("s"), F.col("rank").alias("a"))
        tail = ranks.select(*KEY, F.col("i").alias("t"), F.col("rank").alias("b"))
        intervals = here.withColumn("t", F.col("s") + F.col("h") - size).join(head, [*KEY, "s"])
        if size == 1:
            # The run is one line: both ranks are the same.
            intervals = intervals.withColumn("b", F.col("a"))
        else:
            intervals = intervals.join(tail, [*KEY, "t"])
        copies, _ = scratch.put(_later_copies(intervals.select(*KEY, "s", "h", "a", "b")), "copies")
        found = copies if found is None else found.union(copies)
        if 2 * size > longest:
            return _merged(found)
        # Doubling: a prefix of 2 x size lines is ranked by the ranks of its halves.
        second = ranks.select(*KEY, (F.col("i") - size).alias("i"), F.col("rank").alias("b"))
        pairs, pairs_path = scratch.put(ranks.withColumnRenamed("rank", "a").join(second, [*KEY, "i"]), "pairs")
        doubled = pairs.join(_ranked(pairs, ["a", "b"], "rank"), ["a", "b"]).select(*KEY, "i", "rank")
        scratch.drop(spark, ranks_path)
        ranks, ranks_path = scratch.put(doubled, "ranks")
        scratch.drop(spark, pairs_path)
        size *= 2


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from the text, and ``removed_lines``.

    Lines are equal if they are so without white space at their ends; lines without a word take no part
    and stay or go with the line above them. A run of consecutive lines with at least ``min_words`` words
    (a line has one more than it has spaces) that occurs more than once, in other documents or the same
    one (copies may overlap), stays where it occurs first in the order of ids and lines, and is deleted elsewhere. All maximal
    repeated runs are found, whole texts read. ``removed_lines`` lists the deleted spans ``(s, e)`` of
    line numbers from 0, blank lines not counted, and replaces a column of this name.

    A text whose lines all go becomes empty. Null and empty texts stay as they are. Null ids come last in
    the order. Rows that repeat id and text count as one document and get the same result. No rows give no
    rows. All other columns are kept.
    """
    own = {"__id": F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)), "__text": F.xxhash64(text_col)}
    keyed = docs.withColumns(own)
    spans = repeated_runs(
        keyed.select(F.col("__id").alias("_id"), F.col("__text").alias("_text"), F.col(text_col).alias("_whole")), min_words
    ).toDF("__id", "__text", "__spans")
    found, lines = F.col("__spans"), F.split(text_col, LINE_END, -1)
    # What stays is between the end of one span and the start of the next.
    starts = F.concat(F.array(F.lit(0)), F.transform(found, lambda x: x.e + 1))
    ends = F.concat(F.transform(found, lambda x: x.s), F.array(F.size(lines)))
    kept = F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a)))
    cut = keyed.join(spans, ["__id", "__text"], "left").withColumns({
        text_col: F.when(found.isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")),
        "removed_lines": found,
    })
    return cut.drop(*own, "__spans")
