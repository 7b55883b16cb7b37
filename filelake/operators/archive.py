"""Archive members: visibility, limits, ids, sidecars and counts, from a member manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filelake import constants as C
from filelake.functions import paths as P
from filelake.operators import skew


def visible_members(members: DataFrame) -> DataFrame:
    """Members that are read at all, with name, type and category.

    ``members`` is ``(file_id, inner_path, file_size, pos)``. Directories, resource forks, hidden
    files and oversized members are dropped without being counted.
    """
    ext = P.extension(F.col("filename"))
    return (
        members.where(P.member_visible(F.col("inner_path")) & (F.col("file_size") <= C.MAX_MEMBER_BYTES))
        .withColumn("filename", P.basename(F.col("inner_path")))
        .withColumn("ext", ext)
        .withColumn("category", P.category_of_ext(ext))
    )


def expand(archives: DataFrame, members: DataFrame, root: str) -> DataFrame:
    """One row per stored member of every archive, with its keys and sidecar fields.

    ``archives`` holds live archives: ``file_id, path_lower, path_display, rev, server_modified``.
    Members of an unsupported type, nested archives among them, are not stored. Where two members
    share an id, the later one in the archive is kept.
    """
    stored = visible_members(members).where(F.col("category").isNotNull())
    heads = archives.select(
        "file_id", F.col("path_lower").alias("zip_path"), F.col("path_display").alias("source_zip"),
        "rev", "server_modified",
    )
    inner_id = P.member_id(F.col("file_id"), F.col("inner_path"))
    rows = stored.join(heads, "file_id").select(
        F.col("file_id").alias("zip_id"),
        inner_id.alias("file_id"),
        P.member_path(F.col("zip_path"), F.col("inner_path")).alias("path"),
        "rev",
        P.mime_of_ext(F.col("ext")).alias("mime_type"),
        F.col("file_size").alias("size"),
        P.time_text(F.col("server_modified")).alias("server_modified"),
        "category",
        P.object_uri(root, P.object_key(F.col("category"), inner_id, F.col("ext"))).alias("object_uri"),
        F.col("filename").alias("caption"),
        "source_zip",
        "pos",
    )
    return skew.latest(rows, "file_id", "pos")


def vanished(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Members on record that the new revision of their archive no longer holds: to be deleted.

    ``stored`` and ``current`` are results of ``expand``; only archives in ``current`` count.
    """
    updated = current.select("zip_id").distinct()
    return stored.join(updated, "zip_id", "left_semi").join(current.select("file_id"), "file_id", "left_anti")


def member_totals(members: DataFrame) -> DataFrame:
    """Per archive: members stored, members skipped for their type, stored paths, stored documents."""
    per_path = visible_members(members).groupBy("file_id", "inner_path", "category").agg(
        F.count(F.lit(1)).alias("n")
    )
    # Rows are unique paths by now, so the second step combines map-side as well.
    return per_path.groupBy("file_id").agg(
        F.sum(F.when(F.col("category").isNotNull(), F.col("n")).otherwise(0)).alias("n_members"),
        F.sum(F.when(F.col("category").isNull(), F.col("n")).otherwise(0)).alias("n_skipped"),
        F.count_if(F.col("category").isNotNull()).alias("n_paths"),
        F.sum(F.when(F.col("category") == "docs", F.col("n")).otherwise(0)).alias("n_docs"),
    )


def archive_meta(archives: DataFrame, members: DataFrame) -> DataFrame:
    """Thin sidecar of every archive; one without stored members keeps the count 0."""
    totals = member_totals(members).select("file_id", "n_members")
    return archives.join(totals, "file_id", "left").select(
        "file_id",
        F.col("path_display").alias("path"),
        "rev",
        F.lit("archive").alias("category"),
        "size",
        P.time_text(F.col("server_modified")).alias("server_modified"),
        F.coalesce("n_members", F.lit(0)).cast("bigint").alias("extracted_count"),
    )


def collisions(members: DataFrame) -> DataFrame:
    """Member ids that different member paths of an archive share."""
    stored = visible_members(members).where(F.col("category").isNotNull())
    paths = stored.select(
        "inner_path", P.member_id(F.col("file_id"), F.col("inner_path")).alias("member_id")
    ).distinct()
    shared = paths.groupBy("member_id").agg(F.count(F.lit(1)).alias("n_paths"))
    return shared.where(F.col("n_paths") > 1)
