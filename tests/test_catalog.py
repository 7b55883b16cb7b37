from feeds import change, frame
from pyspark.sql import functions as F

from filelake import schemas
from filelake.operators import catalog, quality, sync
from filelake.sources import feed


def test_cursor_modes(spark):
    rows = frame(spark, [change(n, "file", f"/p{n}.jpg", f"i{n}", "r1") for n in range(5)])
    saved = spark.createDataFrame([(2,)], schemas.SYNC_STATE)
    assert tuple(feed.advance(rows, saved).first()) == ("incremental", 2, 2, 4)
    assert tuple(feed.advance(rows, saved.limit(0)).first()) == ("baseline", None, 5, 4)
    assert tuple(feed.advance(rows.limit(0), saved).first()) == ("incremental", 2, 0, 2)
    assert [r.seq for r in feed.since(rows, saved.select(F.max("cursor"))).orderBy("seq").collect()] == [3, 4]
    assert feed.since(rows, 4).count() == 0


def test_feed_reads_json_and_parquet_alike(spark, tmp_path):
    rows = frame(spark, [change(1, "file", "/p.jpg", "A", "r1", 3 * 1024**3), change(2, "deleted", "/p.jpg")])
    rows.write.json(str(tmp_path / "j"))
    rows.write.parquet(str(tmp_path / "p"))
    want = sorted(tuple(r) for r in rows.collect())
    assert sorted(tuple(r) for r in feed.read_feed(spark, str(tmp_path / "j"), "json").collect()) == want
    assert sorted(tuple(r) for r in feed.read_feed(spark, str(tmp_path / "p")).collect()) == want


def test_sidecar_without_category_leaves_the_object(spark):
    resolved = spark.sql("select 'p' as path_lower, 'A' as file_id union all select 'q', 'B' union all select 'r', null")
    meta = spark.sql("select 'A' as file_id, cast(null as string) as category, 'u/A' as object_uri "
                     "union all select 'B', 'docs', 'u/mirror/docs/B.pdf'")
    keys = {r.file_id: (r.object_key, r.meta_key) for r in sync.doomed_objects(resolved, meta).collect()}
    assert keys == {"A": (None, "mirror/meta/A.json"), "B": ("mirror/docs/B.pdf", "mirror/meta/B.json")}
    objects = spark.sql("select 'mirror/docs/B.pdf' as object_key union all select 'mirror/images/A'")
    doomed = sync.doomed_objects(resolved, meta)
    once = catalog.apply_deletes(objects, doomed)
    # Deleting again is no error.
    assert [r.object_key for r in catalog.apply_deletes(once, doomed).collect()] == ["mirror/images/A"]


def test_valid_ids_for_resync(spark):
    uris = ["l://b/mirror/images/I1", "l://b/mirror/docs/D1.pdf", "l://b/mirror/docs/D2", "l://b/mirror/docs/D3.PDF",
            "l://b/mirror/media/M1", "l://b/mirror/docs/D.4.txt", "l://b/mirror/docs/D5.mp3x4"]
    ids = catalog.valid_ids(spark.createDataFrame([(u,) for u in uris], "object_uri string"))
    assert {r.file_id for r in ids.collect()} == {"I1", "D1", "D.4"}
    revs = spark.createDataFrame([("I1", "r1"), ("D2", "r1"), ("M1", "r1")], schemas.REV_INDEX)
    assert tuple(catalog.resync_summary(revs, ids).first()) == (3, 2, 1)


def test_rebuild_takes_the_last_usable_sidecar(spark):
    rows = [("A", "r1", 0), ("A", "r2", 1), ("A", "", 2), (None, "r1", 3), ("", "r1", 4), ("B", None, 5), ("C", "r1", 6)]
    df = spark.createDataFrame(rows, "file_id string, rev string, pos int")
    assert {tuple(r) for r in catalog.rebuild_revs(df, "pos").collect()} == {("A", "r2"), ("C", "r1")}


def test_missing_objects_have_size_zero(spark):
    wanted = spark.sql("select 'a' as object_key union all select 'b'")
    objects = spark.sql("select 'a' as object_key, 7L as length")
    assert {tuple(r) for r in catalog.sizes_of(wanted, objects).collect()} == {("a", 7), ("b", 0)}


def test_integrity_report_counts_orphans(spark):
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "file_id string")
    meta = spark.sql("select 'A' as file_id, 'images' as category union all select 'B', null")
    report = {r.check: (r.value, r.passed) for r in quality.integrity_report(ids("A", "X"), ids("A", "B"), meta).collect()}
    assert report == {
        "paths_without_meta": (1, False), "revs_without_meta": (0, True), "meta_without_path": (1, False),
        "meta_without_rev": (0, True), "meta_without_category": (1, False),
    }


def test_percent_of_nothing(spark):
    got = spark.range(1).select(catalog.percent(F.lit(0), F.lit(0)), catalog.percent(F.lit(1), F.lit(3))).first()
    assert tuple(got) == (0.0, 33.3)


def test_prefix_filter_reaches_the_scan(spark, tmp_path):
    spark.sql("select 'mirror/docs/a' as object_key, 1L as length").write.parquet(str(tmp_path / "o"))
    plan = catalog.with_prefix(spark.read.parquet(str(tmp_path / "o")), "mirror/docs/")
    assert "StringStartsWith(object_key,mirror/docs/)" in plan._jdf.queryExecution().executedPlan().toString()
