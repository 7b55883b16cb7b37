"""Exact result of applying a feed event by event when paths and ids mix freely.

Which id a deletion removes depends on which file events its path has taken in, and whether a file
event is taken in depends on the deletions its id has seen. Every such dependency points to an
earlier event, so the true outcome is the only fixpoint of two rules:

* path rule: a deletion removes the id last put at its path, if no deletion came in between;
* id rule: a file event is unchanged if its id still holds the same revision.

The first round evaluates both rules for all events at once with windows, starting from "every
acceptable event is taken in". In a large feed every later one evaluates the path rule only on paths where an event
changed, and the id rule only on ids whose deletions changed; what it finds is kept as a small table
of corrections, so settled events are neither sorted nor written again. A round settles at least one
more link of every dependency chain, so the loop ends, and the number of rounds is the longest chain
of deletions across paths and ids, not the number of events. No group of related events is ever
collected: hot paths and hot ids are split by ``skew.with_previous``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filelake.functions import paths as P
from filelake.operators import skew
from filelake.operators.sync import acceptable, archive_cascade, enrich, not_failed, outcome
from filelake.session import estimated_bytes, remove, send_if_small, stage_at

# Rows from which later rounds look only at paths and ids that can still change.
FRONTIER_FROM = 1_000_000
# Corrections, by the size of their files, that go to every task in each later round; more are written into the events.
MAX_PATCH = 2 * 1024**2
# What the rounds find out about an event.
STATUS = ("taken", "target", "prev_rev")


def _own_key(prefix: str):
    """A key no other row shares, for rows that take no part in a rule."""
    return F.concat(F.lit(f"\x00{prefix}"), F.col("kind"), F.col("path_lower"), F.col("file_id"), F.col("seq"))


def _path_rule(events: DataFrame, max_group: int, rows: int) -> DataFrame:
    """Add ``new_target``: the id that a deletion removes, by which events are ``taken``."""
    at_path = F.col("kind").isin("file", "deleted", "seed_path")
    events = events.withColumn("_pkey", F.when(at_path, F.col("path_lower")).otherwise(_own_key("p")))
    holds = F.when(
        (F.col("kind") == "seed_path") | F.col("taken"), F.struct(F.col("file_id").alias("id"))
    ).when(F.col("kind") == "deleted", F.struct(F.lit(None).cast("string").alias("id")))
    out = skew.with_previous(events, "_pkey", "seq", holds, "_at", max_group, rows)
    return out.withColumn("new_target", F.when(F.col("kind") == "deleted", F.col("_at.id"))).drop("_pkey", "_at")


def _id_rule(events: DataFrame, max_group: int, rows: int) -> DataFrame:
    """Add ``new_taken`` and ``new_rev``, the revision that the id held before, by the ``target`` of deletions."""
    owner = (
        F.when(F.col("kind").isin("file", "seed_rev"), F.col("file_id"))
        .when(F.col("target").isNotNull(), F.col("target"))
        .otherwise(_own_key("i"))
    )
    rev = F.when(
        F.col("ok") | (F.col("kind") == "seed_rev"), F.struct(F.col("rev").alias("rev"))
    ).when(F.col("target").isNotNull(), F.struct(F.lit(None).cast("string").alias("rev")))
    out = skew.with_previous(events.withColumn("_ikey", owner), "_ikey", "seq", rev, "_held", max_group, rows)
    held = F.col("_held.rev")
    taken = F.col("ok") & F.coalesce(held != F.col("rev"), F.lit(True))
    return out.withColumn("new_taken", taken).withColumn("new_rev", held).drop("_ikey", "_held")


def _whole_round(events: DataFrame, path: str, max_group: int, rows: int) -> tuple[DataFrame, str]:
    """Both rules for all events, written in place of the table at ``path``."""
    seen = _path_rule(events, max_group, rows).withColumn("target", F.col("new_target"))
    turns = F.col("new_taken") != F.col("taken")
    seen = _id_rule(seen, max_group, rows).withColumns({"moved": turns, "taken": F.col("new_taken"), "prev_rev": F.col("new_rev")})
    base, new_path = stage_at(seen.drop("new_target", "new_taken", "new_rev"), "replay")
    remove(events.sparkSession, path)
    return base, new_path


def _corrected(base: DataFrame, patch: DataFrame | None, send: bool = True) -> DataFrame:
    """Events with the newest ``taken``, ``target`` and ``prev_rev``."""
    if patch is None:
        return base
    own = [F.col(c).alias(f"_{c}") for c in STATUS]
    joined = base.join((send_if_small(patch) if send else patch).select("row", F.lit(True).alias("_own"), *own), "row", "left")
    newest = {c: F.when(F.col("_own"), F.col(f"_{c}")).otherwise(F.col(c)) for c in STATUS}
    return joined.withColumns(newest).select(*base.columns)


def _folded(base: DataFrame, patch: DataFrame, path: str) -> tuple[DataFrame, str]:
    """Events with all corrections, written in place of the table at ``path``; Spark chooses the join."""
    folded, new_path = stage_at(_corrected(base, patch, send=False), "replay")
    remove(base.sparkSession, path)
    return folded, new_path


def _next(
    base: DataFrame, patch: DataFrame | None, last: DataFrame, max_group: int, rows: int
) -> tuple[DataFrame, list[str]]:
    """All corrections of ``base`` after another round, and the folders written for them.

    A correction is the newest status of an event; ``moved`` tells whether the round changed that it is taken in, and
    ``last`` is what the round before this one found.
    """
    events = _corrected(base, patch)
    paths = last.where("moved").select("path_lower").distinct()
    seen = _path_rule(events.join(paths, "path_lower", "left_semi"), max_group, rows)
    hits, hits_path = stage_at(seen.where(~F.col("new_target").eqNullSafe(F.col("target"))), "replay")
    ids = hits.select(F.explode(F.array("target", "new_target")).alias("_id")).where("_id is not null").distinct()
    of_id = F.when(F.col("kind").isin("file", "seed_rev"), F.col("file_id")).otherwise(F.col("target"))
    # Few events are under these ids: the hits meet them alone and never go to all events.
    others = events.withColumn("_id", of_id).join(ids, "_id", "left_semi").drop("_id").join(hits.select("row"), "row", "left_anti")
    turned = hits.where("new_target is not null").withColumn("target", F.col("new_target")).drop("new_target")
    touched = others.withColumn("_hit", F.lit(False)).unionByName(turned.withColumn("_hit", F.lit(True)))
    seen = _id_rule(touched, max_group, rows)
    turns = F.col("new_taken") != F.col("taken")
    newest = F.lit(1).alias("age")
    found = seen.where(turns | F.col("_hit") | ~F.col("new_rev").eqNullSafe(F.col("prev_rev"))).select(
        "row", "path_lower", F.col("new_taken").alias("taken"), "target", F.col("new_rev").alias("prev_rev"), turns.alias("moved"), newest
    )
    # Deletions that remove nothing any more are under no id.
    nothing = F.lit(None).cast("string")
    none = hits.where(F.col("new_target").isNull()).select(
        "row", "path_lower", "taken", nothing.alias("target"), nothing.alias("prev_rev"), F.lit(False).alias("moved"), newest
    )
    known = found.unionByName(none)
    if patch is not None:
        old = patch.withColumns({"moved": F.lit(False), "age": F.lit(0)})
        known = skew.latest(known.unionByName(old), "row", "age")
    known, path = stage_at(known.drop("age"), "replay")
    return known, [hits_path, path]


def replay(
    changes: DataFrame,
    path_index: DataFrame | None = None,
    rev_index: DataFrame | None = None,
    max_group: int = skew.MAX_GROUP,
    frontier_from: int = FRONTIER_FROM,
) -> DataFrame:
    """Settled events, seeds included: ``outcome``, ``taken`` and ``target`` of each.

    ``path_index`` and ``rev_index`` are the state before the feed. Feeds of fewer than ``frontier_from`` rows go through
    whole rounds: there a round costs less than the joins that find what can still change.
    """
    events = (
        enrich(changes.where(F.col("kind") != "folder"))
        .withColumn("file_id", F.coalesce("file_id", F.lit("")))
        .withColumn("ok", acceptable() & not_failed(changes))
        # Every round writes the events, so they carry what the rules and the outcome need.
        .select("seq", "kind", "path_lower", "file_id", "rev", "size", "category", "archive", "ok")
    )
    before = F.lit(-1).cast("bigint").alias("seq")
    off = F.lit(False).alias("ok")
    if path_index is not None:
        events = events.unionByName(
            path_index.select(before, F.lit("seed_path").alias("kind"), "path_lower", "file_id", off),
            allowMissingColumns=True,
        )
    if rev_index is not None:
        events = events.unionByName(
            rev_index.select(
                before, F.lit("seed_rev").alias("kind"), F.lit("").alias("path_lower"), "file_id", "rev", off
            ),
            allowMissingColumns=True,
        )
    events = events.withColumns({
        "taken": F.col("ok"), "target": F.lit(None).cast("string"), "row": F.monotonically_increasing_id(),
    })
    # Written to the shared folder: the loop must not grow its lineage.
    spark = events.sparkSession
    events, path = stage_at(events, "replay")
    rows = events.count()
    base, path = _whole_round(events, path, max_group, rows)
    patch, last, folders = None, base, []
    while not last.where("moved").isEmpty():
        if rows < frontier_from:
            base, path = _whole_round(base.drop("moved", "prev_rev"), path, max_group, rows)
            last = base
            continue
        patch, written = _next(base, patch, last, max_group, rows)
        for folder in folders:
            remove(spark, folder)
        last, folders = patch, written
        if estimated_bytes(patch) > MAX_PATCH:
            base, path = _folded(base, patch, path)
            patch = None
    events = _corrected(base, patch).drop("row", "moved")
    result = F.when(
        F.col("kind") == "deleted",
        F.when(F.col("archive"), "archive_deleted").when(F.col("target").isNull(), "skipped").otherwise("deleted"),
    ).otherwise(outcome())
    return events.withColumn("outcome", F.when(~F.col("kind").startswith("seed"), result))


def final_paths(settled: DataFrame) -> DataFrame:
    """Path index after the feed, plain files and archives."""
    moves = settled.where(F.col("taken") | F.col("kind").isin("deleted", "seed_path"))
    last = skew.latest(moves, "path_lower", "seq")
    return last.where(F.col("kind") != "deleted").select("path_lower", "file_id")


def final_revs(settled: DataFrame) -> DataFrame:
    """Revision index after the feed."""
    seen = settled.where(F.col("ok") | F.col("target").isNotNull() | (F.col("kind") == "seed_rev"))
    owned = seen.withColumn("file_id", F.coalesce("target", "file_id"))
    last = skew.latest(owned, "file_id", "seq")
    return last.where(F.col("kind") != "deleted").select("file_id", "rev")


def final_member_paths(settled: DataFrame, members: DataFrame) -> DataFrame:
    """Path index rows of archive members after the feed.

    A path of an archive keeps the members of every archive taken in there since it was last
    deleted; where two archives name the same member, the later one owns the path. ``members`` is
    ``archive.visible_members``.
    """
    gone = settled.where((F.col("kind") == "deleted") & F.col("archive")).groupBy("path_lower").agg(
        F.max("seq").alias("gone_seq")
    )
    taken = (
        settled.where(F.col("taken") & F.col("archive"))
        .groupBy("path_lower", "file_id")
        .agg(F.max("seq").alias("seq"))
        .join(gone, "path_lower", "left")
        .where(F.coalesce(F.col("seq") > F.col("gone_seq"), F.lit(True)))
    )
    stored = members.where(F.col("category").isNotNull()).select("file_id", "inner_path", "pos")
    rows = taken.join(stored, "file_id").select(
        P.member_path(F.col("path_lower"), F.col("inner_path")).alias("path_lower"),
        P.member_id(F.col("file_id"), F.col("inner_path")).alias("file_id"),
        "seq",
        "pos",
    )
    return skew.latest(rows, "path_lower", [F.col("seq").desc(), F.col("pos").desc()]).select(
        "path_lower", "file_id"
    )


def final_index(settled: DataFrame, members: DataFrame) -> DataFrame:
    """Whole path index after the feed: plain files, archives and archive members.

    A member path from before the feed goes away with the first deletion of its archive.
    """
    kept = final_paths(settled)
    gone = settled.where((F.col("kind") == "deleted") & F.col("archive"))
    old = settled.where((F.col("kind") == "seed_path") & F.col("path_lower").contains("!/"))
    lost = archive_cascade(gone, old).select(F.col("child_path").alias("path_lower"))
    stored = final_member_paths(settled, members)
    rest = kept.join(lost, "path_lower", "left_anti").join(stored, "path_lower", "left_anti")
    return rest.unionByName(stored)
