"""Reports and set operations over the catalog tables, deletes and re-sync."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filelake import constants as C
from filelake.functions import paths as P
from filelake.operators import skew
from filelake.session import small_side


def percent(part: Column, whole: Column) -> Column:
    """Share in percent to one decimal; 0 of nothing is 0."""
    share = F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 1)
    return F.coalesce(share, F.lit(0.0))


def category_counts(meta: DataFrame) -> DataFrame:
    return meta.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def ext_breakdown(meta: DataFrame) -> DataFrame:
    """Documents per extension of their object."""
    ext = P.extension(F.col("object_uri"))
    return meta.where(F.col("category") == "docs").groupBy(ext.alias("ext")).agg(F.count(F.lit(1)).alias("n"))


def with_prefix(objects: DataFrame, prefix: str, column: str = "object_key") -> DataFrame:
    """Objects below a prefix; the predicate reaches the scan as ``StringStartsWith``."""
    return objects.where(F.col(column).startswith(prefix))


def sizes_of(wanted: DataFrame, objects: DataFrame) -> DataFrame:
    """Size of each wanted object; one that cannot be found counts as 0."""
    found = objects.select("object_key", F.col("length").alias("found_length"))
    return wanted.join(found, "object_key", "left").withColumn(
        "length", F.coalesce("found_length", F.lit(0)).cast("bigint")
    ).drop("found_length")


def rebuild_revs(sidecars: DataFrame, order: str) -> DataFrame:
    """Revision index from sidecars that carry an id and a revision; the last one wins."""
    usable = (F.length("file_id") > 0) & (F.length("rev") > 0)
    return skew.latest(sidecars.where(usable), "file_id", order).select("file_id", "rev")


def valid_ids(object_uris: DataFrame) -> DataFrame:
    """Ids whose objects are in order: images, and documents with a plain lower-case extension."""
    uri = F.col("object_uri")
    image = F.regexp_extract(uri, C.IMAGE_URI, 1)
    doc = F.regexp_extract(uri, C.DOC_URI, 1)
    found = F.when(image != "", image).when(doc != "", doc)
    return object_uris.select(found.alias("file_id")).where(F.col("file_id").isNotNull()).distinct()


def resync_keep(rev_index: DataFrame, keep_ids: DataFrame) -> DataFrame:
    return rev_index.join(keep_ids, "file_id", "left_semi")


def resync_removed(rev_index: DataFrame, keep_ids: DataFrame) -> DataFrame:
    return rev_index.join(keep_ids, "file_id", "left_anti")


def resync_summary(rev_index: DataFrame, keep_ids: DataFrame) -> DataFrame:
    """Entries before, removed and kept, in one pass over the index."""
    marked = rev_index.join(keep_ids.withColumn("_keep", F.lit(True)), "file_id", "left")
    kept = F.count_if(F.col("_keep").isNotNull())
    return marked.agg(
        F.count(F.lit(1)).alias("original"),
        (F.count(F.lit(1)) - kept).alias("removed"),
        kept.alias("kept"),
    )


def apply_deletes(objects: DataFrame, doomed: DataFrame) -> DataFrame:
    """Objects that remain. Deleting what is not there is no error."""
    keys = small_side(doomed.where(F.col("object_key").isNotNull()).select("object_key").distinct(), "doomed")
    return objects.join(keys, "object_key", "left_anti")
