import random

import pytest
from feeds import frame, random_feed, replay
from pyspark.sql import functions as F
from test_sync import paired

from filelake.sources import objects
from filelake.streaming.sync import SyncJob


def state(job):
    return {r.path_lower: (r.file_id, r.rev) for r in job.live.read().collect()}


def expected(rows):
    _, where, revs = replay(rows)
    return {p: (i, revs[i]) for p, i in where.items()}


def test_stream_equals_replay_and_stops_when_nothing_is_new(spark, tmp_path):
    rows = paired(random.Random(6), 240)
    job, feed = SyncJob(spark, str(tmp_path / "job"), max_group=30, compact_after=2), str(tmp_path / "feed")
    for start in range(0, 240, 120):
        frame(spark, rows[start : start + 120]).coalesce(1).write.mode("append").parquet(feed)
        assert job.run(feed) == [120]
        assert job.run(feed) == []
        assert state(job) == expected(rows[: start + 120])
    assert job.cursor.read().first().cursor == 239
    counts = {r.outcome: r.n for r in job.counts.read().collect()}
    want = {}
    for outcome in list(replay(rows)[0].values()) + ["folder"] * sum(r[1] == "folder" for r in rows):
        want[outcome] = want.get(outcome, 0) + 1
    assert counts == want
    metas = {r.file_id: r.object_uri for r in job.sidecars("lake://t").collect()}
    assert set(metas) == {i for p, (i, _) in state(job).items() if not p.endswith(".zip")}
    # A full snapshot in place of the deltas changes nothing.
    assert job.live.versions()[-1] == (1, True)
    assert state(job) == expected(rows)


def test_repeated_and_broken_off_batches(spark, tmp_path):
    rows = paired(random.Random(7), 120)
    job = SyncJob(spark, str(tmp_path / "job"))
    first, second = frame(spark, rows[:60]), frame(spark, rows[60:])
    job.apply(first, 0)
    # What a batch that broke off before its cursor leaves behind.
    job.live.write(1, second.select("path_lower").distinct().selectExpr(
        "path_lower", "'bad' as file_id", "'bad' as rev", "'' as category", "0L as size", "0L as seq", "'' as name",
        "'' as path_display", "timestamp_ntz'2024-01-01 00:00:00' as server_modified", "'' as ext", "false as archive"))
    job.apply(second, 1)
    job.apply(second, 1)
    job.apply(second, 1, again=True)
    assert state(job) == expected(rows)
    assert sum(r.n for r in job.counts.read().collect()) == 120


def test_failed_fetch_is_not_committed_and_tried_again(spark, tmp_path):
    from feeds import change

    def fetch(attempted):
        bad = (F.col("attempts") == 0) & F.col("name").isin("a.jpg", "b.jpg")
        return attempted.select("seq", F.when(bad, "read error").alias("error"))

    job = SyncJob(spark, str(tmp_path / "job"), fetch=fetch)
    job.apply(frame(spark, [change(0, "file", "/a.jpg", "A", "r1"), change(1, "file", "/b.jpg", "B", "r1"),
                            change(2, "file", "/c.jpg", "C", "r1"), change(3, "deleted", "/b.jpg")]), 0)
    assert state(job) == {"/c.jpg": ("C", "r1")}
    assert [r.path_lower for r in job.retry.read().collect()] == ["/a.jpg"]
    job.apply(frame(spark, []), 1)
    assert state(job) == {"/a.jpg": ("A", "r1"), "/c.jpg": ("C", "r1")}
    assert job.retry.read().count() == 0
    assert job.cursor.read().first().cursor == 3


def test_fetcher_stores_objects_and_reports_missing_ones(spark, tmp_path):
    from feeds import change

    source = tmp_path / "source"
    source.mkdir()
    (source / "a.jpg").write_bytes(b"picture")
    job = SyncJob(spark, str(tmp_path / "job"), fetch=objects.fetcher(str(source), str(tmp_path / "lake")))
    job.apply(frame(spark, [change(0, "file", "/a.jpg", "A", "r1"), change(1, "file", "/b.pdf", "B", "r1"),
                            change(2, "file", "/z.zip", "Z", "r1")]), 0)
    assert state(job) == {"/a.jpg": ("A", "r1"), "/z.zip": ("Z", "r1")}
    assert (tmp_path / "lake" / "mirror" / "images" / "A").read_bytes() == b"picture"
    (source / "b.pdf").write_bytes(b"text")
    job.apply(frame(spark, []), 1)
    assert (tmp_path / "lake" / "mirror" / "docs" / "B.pdf").read_bytes() == b"text"
    assert state(job)["/b.pdf"] == ("B", "r1")


def test_all_batches_of_a_run_are_listed(spark, tmp_path):
    """More batches than the stream's own progress remembers."""
    rows = paired(random.Random(8), 60)
    job, feed = SyncJob(spark, str(tmp_path / "job")), str(tmp_path / "feed")
    for start in range(0, 60, 15):
        frame(spark, rows[start : start + 15]).coalesce(1).write.mode("append").parquet(feed)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        assert job.run(feed, max_files=1) == [15] * 4
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert sum(r.n for r in job.counts.read().collect()) == 60


def test_two_failing_events_of_a_file_count_twice(spark, tmp_path):
    from feeds import change

    job = SyncJob(spark, str(tmp_path / "job"), fetch=objects.fetcher(str(tmp_path), str(tmp_path / "lake")))
    job.apply(frame(spark, [change(0, "file", "/a.jpg", "A", "r1"), change(1, "file", "/a.jpg", "A", "r2")]), 0)
    assert {r.outcome: r.n for r in job.counts.read().collect()} == {"skipped": 2}
    assert state(job) == {} and job.retry.read().count() == 1


def test_removed_objects_and_missing_ones(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x")
    paths = spark.createDataFrame([(f"{tmp_path}/a",), (f"{tmp_path}/a",), (f"{tmp_path}/b",)], "path string")
    done = {r.path[-1]: (r.removed, r.error) for r in objects.remove(paths).collect()}
    assert done == {"a": (True, None), "b": (False, None)} and not (tmp_path / "a").exists()


@pytest.mark.parametrize("seed", [1, 2])
def test_moving_feed_in_batches_equals_plain_replay(spark, tmp_path, seed):
    rows = random_feed(seed, 120)
    job = SyncJob(spark, str(tmp_path / "job"), compact_after=2)
    for number, start in enumerate(range(0, 120, 40)):
        job.apply(frame(spark, rows[start : start + 40]), number)
        job.apply(frame(spark, rows[start : start + 40]), number, again=number == 0)
    outcomes, where, revs = replay(rows)
    assert {r.path_lower: r.file_id for r in job.paths.read().collect()} == where
    assert {r.file_id: r.rev for r in job.revs.read().collect()} == revs
    counts = {}
    for outcome in [*outcomes.values(), *["folder"] * sum(r[1] == "folder" for r in rows)]:
        counts[outcome] = counts.get(outcome, 0) + 1
    assert {r.outcome: r.n for r in job.counts.read().collect()} == counts


def test_renamed_file_in_a_later_batch(spark, tmp_path):
    from feeds import change

    job = SyncJob(spark, str(tmp_path / "job"))
    job.apply(frame(spark, [change(0, "file", "/p1.jpg", "A", "r1")]), 0)
    job.apply(frame(spark, [change(1, "file", "/p2.jpg", "A", "r1")]), 1)
    assert {r.outcome: r.n for r in job.counts.read().collect()} == {"synced": 1, "unchanged": 1}
    assert [tuple(r) for r in job.paths.read().collect()] == [("/p1.jpg", "A")]


def test_revision_of_an_archive_deleted_twice_ends(spark, tmp_path, monkeypatch):
    """Its id would stay on record without a path, and all events of a later batch would go through the exact replay."""
    from feeds import change

    from filelake.streaming import sync

    monkeypatch.setattr(sync.replay, "replay", lambda *_: 1 / 0)
    job = SyncJob(spark, str(tmp_path / "job"))
    job.apply(frame(spark, [change(0, "file", "/z.zip", "Z", "r1")]), 0)
    job.apply(frame(spark, [change(1, "deleted", "/z.zip"), change(2, "deleted", "/z.zip")]), 1)
    assert job.revs.read().count() == 0 and job.paths.read().count() == 0
    job.apply(frame(spark, [change(3, "file", "/z.zip", "Z", "r1")]), 2)
    assert {r.outcome: r.n for r in job.counts.read().collect()} == {"archive": 2, "archive_deleted": 2}
    assert [tuple(r) for r in job.revs.read().collect()] == [("Z", "r1")]


def test_only_paths_with_a_new_failure_are_judged_again(spark, tmp_path, monkeypatch):
    from feeds import change

    from filelake.streaming import sync

    asked, judged = [], []

    def fetch(attempted):
        asked.append(sorted(r.seq for r in attempted.select("seq").collect()))
        return attempted.select("seq", F.when(F.col("seq").isin(0, 1, 5), "read error").alias("error"))

    plain = sync.classify
    monkeypatch.setattr(sync, "classify", lambda events, *a, **k: judged.append(
        sorted(r.seq for r in events.select("seq").collect())) or plain(events, *a, **k))
    rows = [change(i, "file", "/a.jpg", "A", "r1") for i in range(3)] + [change(3, "file", "/b.jpg", "B", "r1")]
    rows += [change(4, "file", "/c.jpg", "C", "r1"), change(5, "file", "/c.jpg", "C", "r2"), change(6, "deleted", "/c.jpg")]
    job = SyncJob(spark, str(tmp_path / "job"), fetch=fetch)
    job.apply(frame(spark, rows), 0)
    # The copy of a failed revision is fetched in its place; the rest is fetched once.
    assert asked == [[0, 3, 4, 5], [1], [2]]
    assert judged == [[0, 1, 2, 3, 4, 5, 6], [0, 1, 2, 4, 5, 6], [0, 1, 2]]
    assert state(job) == {"/a.jpg": ("A", "r1"), "/b.jpg": ("B", "r1")}
    assert {r.outcome: r.n for r in job.counts.read().collect()} == {"synced": 3, "skipped": 3, "deleted": 1}
    assert job.retry.read().count() == 0
