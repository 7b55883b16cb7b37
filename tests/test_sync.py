import random

import pytest
from feeds import change, frame, random_feed, replay
from pyspark.sql import functions as F

from filelake.constants import MAX_ARCHIVE_BYTES, MAX_FILE_BYTES
from filelake.operators import archive, skew, sync
from filelake.operators import replay as exact


def outcomes(df):
    return {r.seq: r.outcome for r in df.where(~F.col("kind").startswith("seed")).select("seq", "outcome").collect()}


def paired(rng, n):
    """Feed in which each path has one id."""
    rows = []
    for seq in range(n):
        p = 0 if rng.random() < 0.4 else rng.randrange(20)
        path = f"/d/p{p}" + [".jpg", ".pdf", ".zip", ".exe"][p % 4]
        kind = rng.choice(["file", "file", "deleted", "folder"])
        size = rng.choice([5, MAX_FILE_BYTES, MAX_FILE_BYTES + 1, MAX_ARCHIVE_BYTES + 1])
        rows.append(change(seq, kind, path, f"i{p}" if kind == "file" else None, f"r{rng.randrange(2)}", size))
    return rows


@pytest.mark.parametrize("max_group", [7, 50, 1_000_000])
def test_window_form_equals_replay_with_a_hot_path(spark, max_group):
    rows = paired(random.Random(3), 600)
    got = outcomes(sync.classify(frame(spark, rows), max_group=max_group).where(F.col("kind") != "folder"))
    assert got == replay(rows)[0]


def test_prior_state(spark):
    rows = paired(random.Random(4), 300)
    prior = {f"/d/p{p}" + [".jpg", ".pdf", ".zip", ".exe"][p % 4]: f"i{p}" for p in range(10)}
    revs = {i: "r0" for i in prior.values()}
    seeds = spark.createDataFrame([(p, i, "r0") for p, i in prior.items()], "path_lower string, file_id string, rev string")
    got = outcomes(sync.classify(frame(spark, rows), seeds, max_group=20).where(F.col("kind") != "folder"))
    assert got == replay(rows, (), prior, revs)[0]


def live(spark, *rows):
    df = sync.fold_latest(frame(spark, list(rows)))
    return {(r.path_lower, r.file_id) for r in df.collect()}


def test_fold_keeps_a_moved_file(spark):
    a, b = change(0, "file", "/p1.jpg", "A", "r1"), change(1, "file", "/p2.jpg", "A", "r2")
    assert live(spark, a, b, change(2, "deleted", "/p1.jpg")) == {("/p2.jpg", "A")}


def test_fold_follows_a_rename_at_the_same_revision(spark):
    rows = [change(0, "file", "/p1.jpg", "A", "r1"), change(1, "file", "/p2.jpg", "A", "r1")]
    assert live(spark, *rows) == {("/p2.jpg", "A")}
    settled = exact.replay(frame(spark, rows))
    assert {tuple(r) for r in exact.final_paths(settled).collect()} == {("/p1.jpg", "A")}


def test_replay_loses_a_moved_file(spark):
    rows = [change(0, "file", "/p1.jpg", "A", "r1"), change(1, "file", "/p2.jpg", "A", "r2"),
            change(2, "deleted", "/p1.jpg")]
    settled = exact.replay(frame(spark, rows))
    assert {tuple(r) for r in exact.final_paths(settled).collect()} == {("/p2.jpg", "A")}
    assert exact.final_revs(settled).count() == 0


def test_folder_deletion_does_not_cascade(spark):
    assert live(spark, change(0, "file", "/d/a.jpg", "A", "r1"), change(1, "deleted", "/d")) == {("/d/a.jpg", "A")}


def test_unknown_deletion_is_skipped(spark):
    assert outcomes(sync.classify(frame(spark, [change(0, "deleted", "/p9.jpg")]))) == {0: "skipped"}


def test_limits(spark):
    rows = [change(0, "file", "/a.jpg", "A", "r1", MAX_FILE_BYTES), change(1, "file", "/b.jpg", "B", "r1", MAX_FILE_BYTES + 1),
            change(2, "file", "/c.zip", "C", "r1", MAX_ARCHIVE_BYTES), change(3, "file", "/d.zip", "D", "r1", MAX_ARCHIVE_BYTES + 1),
            change(4, "file", "/c.zip", "C", "r1", MAX_ARCHIVE_BYTES + 1)]
    assert outcomes(sync.classify(frame(spark, rows))) == {
        0: "synced", 1: "skipped", 2: "archive", 3: "skipped", 4: "unchanged"
    }


@pytest.mark.parametrize("seed, hot, max_group, frontier_from", [
    (1, 0.0, 1_000_000, 0), (2, 0.5, 9, 0), (3, 0.3, 40, 0), (4, 0.0, 1_000_000, 10**9), (5, 0.5, 9, 10**9),
])
def test_replay_equals_plain_replay(spark, seed, hot, max_group, frontier_from):
    rows = random_feed(seed, 500, hot=hot)
    members = [(f"i{i}", inner) for i in range(9) for inner in ("a/x.jpg", "a_x.jpg", "y.pdf")[: i % 4]]
    paths = {"/d/p0.jpg": "i0", "/d/p2.zip": "i2", "/d/p2.zip!/old.jpg": "i2___old.jpg", "/d/p5.pdf": "i1"}
    revs = {"i0": "r0", "i2": "r1", "i1": "r1", "i7": "r0"}
    want, want_paths, want_revs = replay(rows, members, paths, revs)
    settled = exact.replay(
        frame(spark, rows), spark.createDataFrame(list(paths.items()), "path_lower string, file_id string"),
        spark.createDataFrame(list(revs.items()), "file_id string, rev string"), max_group, frontier_from,
    )
    assert outcomes(settled) == want
    assert {r.file_id: r.rev for r in exact.final_revs(settled).collect()} == want_revs
    manifest = spark.createDataFrame(
        [(z, inner, 5, n) for n, (z, inner) in enumerate(members)], "file_id string, inner_path string, file_size bigint, pos bigint"
    )
    index = exact.final_index(settled, archive.visible_members(manifest))
    got = {r.path_lower: r.file_id for r in index.collect()}
    assert index.count() == len(got)
    assert got == want_paths


@pytest.mark.parametrize("frontier_from", [0, 10**9])
def test_replay_chain(spark, frontier_from):
    """Each deletion decides what the next one finds, across many paths and ids."""
    rows, seq = [], 0
    for step in range(12):
        for row in (("file", f"/p{step}.jpg", f"i{step}", "r0"), ("file", f"/p{step + 1}.jpg", f"i{step}", "r0"),
                    ("deleted", f"/p{step}.jpg", None, None), ("file", f"/p{step + 1}.jpg", f"i{step}", "r0")):
            rows.append(change(seq, *row))
            seq += 1
    assert outcomes(exact.replay(frame(spark, rows), frontier_from=frontier_from)) == replay(rows)[0]


def test_with_previous_splits_hot_keys(spark):
    rng = random.Random(8)
    rows = [(seq, "hot" if rng.random() < 0.5 else f"k{rng.randrange(30)}", rng.choice([None, seq])) for seq in range(0, 3000, 3)]
    df = spark.createDataFrame(rows, "seq bigint, key string, v bigint")
    got = skew.with_previous(df, "key", "seq", F.col("v"), "prev", max_group=25)
    last, want = {}, {}
    for seq, key, v in rows:
        want[seq] = last.get(key)
        last[key] = v if v is not None else last.get(key)
    assert {r.seq: r.prev for r in got.collect()} == want


def test_archive_counters(spark):
    rows = [change(0, "file", "/z.zip", "Z", "r1"), change(1, "file", "/z.zip", "Z", "r2"), change(2, "deleted", "/z.zip"),
            change(3, "deleted", "/z.zip")]
    manifest = spark.createDataFrame(
        [("Z", "a.jpg", 5, 0), ("Z", "b.pdf", 5, 1), ("Z", "c.exe", 5, 2), ("Z", "n.zip", 5, 3), ("Z", ".h.jpg", 5, 4),
         ("Z", "big.jpg", 1024**3 + 1, 5)],
        "file_id string, inner_path string, file_size bigint, pos bigint",
    )
    got = sync.counters(sync.classify(frame(spark, rows)), archive.member_totals(manifest))
    assert {r.counter: r.n for r in got.collect()} == {
        "synced": 0, "deleted": 2, "skipped": 4, "unchanged": 0, "zip_extracted": 4, "docs_imported": 2
    }


def test_member_collision_keeps_the_later_member(spark):
    manifest = spark.createDataFrame(
        [("Z", "x/y.jpg", 5, 0), ("Z", "x_y.jpg", 7, 1)], "file_id string, inner_path string, file_size bigint, pos bigint"
    )
    heads = spark.sql("select 'Z' as file_id, '/z.zip' as path_lower, '/Z.zip' as path_display, 'r1' as rev, timestamp_ntz'2024-01-01 00:00:00' as server_modified")
    assert [r.size for r in archive.expand(heads, manifest, "lake://t").collect()] == [7]
    assert [(r.member_id, r.n_paths) for r in archive.collisions(manifest).collect()] == [("Z___x_y.jpg", 2)]


def test_new_archive_revision_replaces_the_members(spark):
    heads = spark.sql("select 'Z' as file_id, '/z.zip' as path_lower, '/Z.zip' as path_display, 'r2' as rev, timestamp_ntz'2024-01-01 00:00:00' as server_modified")
    schema = "file_id string, inner_path string, file_size bigint, pos bigint"
    old = archive.expand(heads, spark.createDataFrame([("Z", "a.jpg", 1, 0), ("Z", "b.jpg", 1, 1)], schema), "lake://t")
    new = archive.expand(heads, spark.createDataFrame([("Z", "a.jpg", 1, 0)], schema), "lake://t")
    assert [r.file_id for r in archive.vanished(old, new).collect()] == ["Z___b.jpg"]


def test_large_corrections_are_written_into_the_events(spark, monkeypatch):
    """They are not sent to every task in each later round."""
    patches, sent = [], []
    plain, send = exact._next, exact.send_if_small
    monkeypatch.setattr(exact, "MAX_PATCH", 0)
    monkeypatch.setattr(exact, "_next", lambda base, patch, *a: patches.append(patch) or plain(base, patch, *a))
    monkeypatch.setattr(exact, "send_if_small", lambda df: sent.append(df) or send(df))
    rows = []
    for step in range(8):
        for kind, path, ident in (("file", step, f"i{step}"), ("file", step + 1, f"i{step}"), ("deleted", step, None), ("file", step + 1, f"i{step}")):
            rows.append(change(len(rows), kind, f"/p{path}.jpg", ident, ident and "r0"))
    settled = exact.replay(frame(spark, rows), frontier_from=0)
    assert outcomes(settled) == replay(rows)[0]
    assert patches and all(p is None for p in patches)
    assert sent == []
