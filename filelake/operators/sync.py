"""Change feed to catalog: outcome of every event, counters, and the folded live state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filelake import constants as C
from filelake.functions import paths as P
from filelake.functions import text as X
from filelake.operators import skew


def enrich(changes: DataFrame) -> DataFrame:
    """Add the derived columns every later step uses; all native expressions in one projection."""
    ext = P.extension(F.col("name"))
    return (
        changes.withColumn("file_id", P.clean_id(F.col("raw_id")))
        .withColumn("ext", ext)
        .withColumn("category", P.category_of_ext(ext))
        .withColumn(
            "archive",
            F.when(F.col("kind") == "deleted", F.col("path_lower").endswith(".zip")).otherwise(
                P.is_archive(F.col("name"))
            ),
        )
    )


def within_limit() -> Column:
    limit = F.when(F.col("archive"), F.lit(C.MAX_ARCHIVE_BYTES)).otherwise(F.lit(C.MAX_FILE_BYTES))
    return F.col("size") <= limit


def acceptable() -> Column:
    """File event that may enter the mirror: an archive or a supported type, within its limit."""
    supported = F.col("archive") | F.col("category").isNotNull()
    return (F.col("kind") == "file") & supported & within_limit()


def not_failed(events: DataFrame) -> Column:
    """Events may carry ``failed``: their file could not be fetched."""
    return ~F.col("failed") if "failed" in events.columns else F.lit(True)


def with_previous_rev(
    changes: DataFrame,
    prior: DataFrame | None = None,
    max_group: int = skew.MAX_GROUP,
    rows: int | None = None,
) -> DataFrame:
    """Enriched non-folder events with ``prev_rev`` and ``prev_id``: what the path held just before.

    The feed must pair paths and ids one to one; ``replay.replay`` covers the general case.
    ``prior`` is ``(path_lower, file_id, rev)``, the state before this feed; ``rows`` is how many rows both
    have at most, if the caller knows. Events with ``failed`` set are not taken in.
    """
    events = enrich(changes.where(F.col("kind") != "folder"))
    events = events.withColumn("ok", acceptable() & not_failed(events))
    if prior is not None:
        seeds = prior.select(
            F.lit(-1).cast("bigint").alias("seq"), F.lit("seed").alias("kind"), "path_lower", "file_id", "rev",
            F.lit(True).alias("ok"),
        )
        events = events.unionByName(seeds, allowMissingColumns=True)
    # A deletion leaves a state of its own: a struct that holds no revision.
    state = F.when(
        F.col("ok") | (F.col("kind") == "deleted"),
        F.struct(*[F.when(F.col("kind") != "deleted", F.col(c)).alias(c) for c in ("rev", "file_id")]),
    )
    out = skew.with_previous(events, "path_lower", "seq", state, "_state", max_group, rows)
    if prior is not None:
        out = out.where(F.col("kind") != "seed")
    return out.withColumns({"prev_rev": F.col("_state.rev"), "prev_id": F.col("_state.file_id")}).drop("_state")


def outcome() -> Column:
    """Outcome of an event from ``kind, archive, category, size, rev, prev_rev``; the order counts.

    An archive is compared by revision before its size is looked at, a plain file after.
    """
    same = F.coalesce(F.col("rev") == F.col("prev_rev"), F.lit(False))
    return (
        F.when(F.col("kind") == "folder", "folder")
        .when((F.col("kind") == "deleted") & F.col("archive"), "archive_deleted")
        .when((F.col("kind") == "deleted") & F.col("prev_rev").isNull(), "skipped")
        .when(F.col("kind") == "deleted", "deleted")
        .when(F.col("archive") & same, "unchanged")
        .when(F.col("archive") & ~within_limit(), "skipped")
        .when(F.col("archive"), "archive")
        .when(F.col("category").isNull(), "skipped")
        .when(~within_limit(), "skipped")
        .when(same, "unchanged")
        .otherwise("synced")
    )


def classify(
    changes: DataFrame,
    prior: DataFrame | None = None,
    max_group: int = skew.MAX_GROUP,
    rows: int | None = None,
) -> DataFrame:
    """Every event with its ``outcome``; folders bypass the state window."""
    folders = changes.where(F.col("kind") == "folder")
    events = with_previous_rev(changes, prior, max_group, rows)
    events = events.withColumn("outcome", F.when(~not_failed(events), "skipped").otherwise(outcome()))
    return events.unionByName(
        enrich(folders).withColumn("outcome", F.lit("folder")), allowMissingColumns=True
    )


def outcome_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def counters(classified: DataFrame, member_totals: DataFrame) -> DataFrame:
    """Job counters ``(counter, n)`` with archive members counted in.

    ``member_totals`` is ``archive.member_totals``: per archive id the members stored, skipped,
    their distinct paths, and the documents among them. An archive event adds its members; deleting
    a live archive counts each member path, not the archive. ``docs_imported`` is what was queued.
    """
    # A deletion names a path only: its archive is the one the path held.
    owner = F.when(F.col("kind") == "deleted", F.col("prev_id")).otherwise(F.col("file_id"))
    per_archive = (
        classified.where(F.col("archive"))
        .groupBy(owner.alias("file_id"))
        .agg(
            F.count_if(F.col("outcome") == "archive").alias("stored"),
            F.count_if(
                (F.col("outcome") == "archive_deleted") & F.col("prev_rev").isNotNull()
            ).alias("removed"),
        )
        .join(member_totals, "file_id", "left")
        .agg(
            F.sum(F.col("stored") * F.col("n_members")).alias("zip_extracted"),
            F.sum(F.col("stored") * F.col("n_skipped")).alias("skipped"),
            F.sum(F.col("removed") * F.col("n_paths")).alias("deleted"),
            F.sum(F.col("stored") * F.col("n_docs")).alias("docs_imported"),
        )
    )
    plain = classified.agg(
        F.count_if(F.col("outcome") == "synced").alias("synced"),
        F.count_if(F.col("outcome") == "deleted").alias("deleted"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped"),
        F.count_if(F.col("outcome") == "unchanged").alias("unchanged"),
        F.count_if((F.col("outcome") == "synced") & (F.col("category") == "docs")).alias("docs_imported"),
    )
    both = plain.unionByName(per_archive, allowMissingColumns=True)
    names = ["synced", "deleted", "skipped", "unchanged", "zip_extracted", "docs_imported"]
    one_row = both.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names])
    return one_row.unpivot([], names, "counter", "n")


def fold_latest(changes: DataFrame) -> DataFrame:
    """Live files after the feed: the last event wins per path, then per id.

    An id lives at the path of its last event, and only while that path was not deleted or taken
    over since. So a move listed as new-then-delete keeps the file, and a rename moves it even when
    the revision stayed the same.
    """
    events = enrich(changes).where(acceptable() | (F.col("kind") == "deleted"))
    owners = skew.latest(events, "path_lower", "seq").where(F.col("kind") == "file")
    return skew.latest(owners, "file_id", "seq")


def file_meta(live: DataFrame, root: str) -> DataFrame:
    """Sidecar row of every plain file in ``live``."""
    key = P.object_key(F.col("category"), F.col("file_id"), F.col("ext"))
    return live.where(~F.col("archive")).select(
        "file_id",
        F.col("path_display").alias("path"),
        "rev",
        P.mime_of_ext(F.col("ext")).alias("mime_type"),
        "size",
        P.time_text(F.col("server_modified")).alias("server_modified"),
        "category",
        P.object_uri(root, key).alias("object_uri"),
        F.col("name").alias("caption"),
        F.lit(None).cast("string").alias("source_zip"),
        F.lit(None).cast("bigint").alias("extracted_count"),
    )


def unchanged_against(changes: DataFrame, rev_index: DataFrame) -> DataFrame:
    """Every file event with the revision on record for its id and whether it is the same."""
    held = rev_index.select("file_id", F.col("rev").alias("held_rev"))
    files = changes.where(F.col("kind") == "file").withColumn("file_id", P.clean_id(F.col("raw_id")))
    return files.join(held, "file_id", "left").withColumn(
        "unchanged", F.coalesce(F.col("rev") == F.col("held_rev"), F.lit(False))
    )


def resolve_deletes(changes: DataFrame, path_index: DataFrame) -> DataFrame:
    """Every plain deletion with the id its path holds; a path without one is skipped."""
    deletes = changes.where((F.col("kind") == "deleted") & ~F.col("path_lower").endswith(".zip"))
    return deletes.select("seq", "path_lower").join(path_index, "path_lower", "left").withColumn(
        "outcome", F.when(F.col("file_id").isNull(), "skipped").otherwise("deleted")
    )


def doomed_objects(resolved: DataFrame, meta: DataFrame) -> DataFrame:
    """Object and sidecar keys to remove for resolved deletions.

    A sidecar without a category loses the sidecar only; the object key stays null.
    """
    sidecar = meta.select("file_id", "category", "object_uri")
    ext = F.when(F.col("category") == "docs", P.raw_extension(F.coalesce("object_uri", F.lit(""))))
    return (
        resolved.where(F.col("file_id").isNotNull())
        .select("path_lower", "file_id")
        .distinct()
        .join(sidecar, "file_id", "left")
        .select(
            "path_lower",
            "file_id",
            P.object_key(F.col("category"), F.col("file_id"), F.coalesce(ext, F.lit(""))).alias("object_key"),
            P.meta_key(F.col("file_id")).alias("meta_key"),
        )
    )


def archive_cascade(deleted_archives: DataFrame, path_index: DataFrame) -> DataFrame:
    """Paths that go away with a deleted archive, by equi-join on each path's parent archives."""
    below = path_index.where(F.col("path_lower").contains(".zip!/")).select(
        F.col("path_lower").alias("child_path"), F.col("file_id").alias("child_id")
    )
    children = X.each(below, ["child_path", "child_id"], P.archive_parents(F.col("child_path")), "path_lower")
    gone = deleted_archives.select("path_lower").distinct()
    return children.join(gone, "path_lower").select(
        F.col("path_lower").alias("archive_path"), "child_path", "child_id"
    )
