"""Document import: manifest lines, ordered batches, result normalisation and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from filelake import constants as C
from filelake import schemas
from filelake.functions import paths as P
from filelake.session import stage


def manifest(uris: DataFrame) -> DataFrame:
    """Manifest row per document URI: ``id, mime_type, uri`` and its JSON ``line``."""
    uri = F.col("uri")
    rows = uris.select(
        P.uri_id(uri).alias("id"), P.mime_of_ext(P.extension(P.basename(uri))).alias("mime_type"), "uri"
    )
    content = F.struct(F.col("mime_type").alias("mimeType"), F.col("uri"))
    return rows.withColumn("line", F.to_json(F.struct("id", content.alias("content"))))


def row_index(df: DataFrame, order: str) -> DataFrame:
    """Add ``idx``: the 0-based position in the order of the unique column ``order``.

    The rows are range-partitioned and sorted, written once, and each partition is shifted by the
    rows before it. No task sees more than its range, and the written table makes the positions
    the same however often they are read.
    """
    placed = df.repartitionByRange(order).sortWithinPartitions(order).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place")
    )
    placed = stage(placed, "ordered")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_place").alias("_first"))
    # One row per task of the write, whatever the data: a running sum over them is no bottleneck.
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.select(
        "_part", "_first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_shift")
    )
    return placed.join(F.broadcast(shifts), "_part").withColumn(
        "idx", F.col("_shift") + F.col("_place") - F.col("_first")
    ).drop("_part", "_place", "_first", "_shift")


def batches(uris: DataFrame, size: int = C.IMPORT_BATCH) -> DataFrame:
    """Import requests ``(batch_id, uris, mode)`` of ``size`` URIs each, in URI order."""
    return requests(row_index(uris.select("uri"), "uri"), size)


def requests(numbered: DataFrame, size: int = C.IMPORT_BATCH) -> DataFrame:
    """Import requests of ``size`` numbered URIs ``(idx, uri)`` each."""
    cell = F.struct("idx", "uri")
    return numbered.groupBy(F.floor(F.col("idx") / F.lit(size)).alias("batch_id")).agg(
        F.transform(F.array_sort(F.collect_list(cell)), lambda c: c["uri"]).alias("uris"),
    ).withColumn("mode", F.lit("INCREMENTAL"))


def normalize(results: DataFrame) -> DataFrame:
    """Success and failure counts of ``(op_id, n_uris, body)``, ``body`` being the JSON answer.

    Not done yet: all count as success. An error, or no answer at all: all failed. Otherwise the
    counts given, which default to all and none. An empty request is (0, 0).
    """
    r = F.from_json(F.col("body"), schemas.IMPORT_RESPONSE)
    n = F.col("n_uris").cast("bigint")
    none = F.lit(0).cast("bigint")
    parsed = results.withColumn("r", r)
    running = F.coalesce(~F.col("r.done"), F.lit(False))
    failed = F.col("body").isNull() | F.col("r.error").isNotNull()
    success = (
        F.when(n == 0, none).when(F.col("body").isNull(), none).when(running, n).when(failed, none)
        .otherwise(F.coalesce(F.col("r.metadata.successCount").cast("bigint"), n))
    )
    failure = (
        F.when(n == 0, none).when(F.col("body").isNull(), n).when(running, none).when(failed, n)
        .otherwise(F.coalesce(F.col("r.metadata.failureCount").cast("bigint"), none))
    )
    return parsed.select("op_id", success.alias("success"), failure.alias("failed"))


def import_totals(normalized: DataFrame) -> DataFrame:
    total = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("success", "failed")]
    return normalized.agg(*total)
