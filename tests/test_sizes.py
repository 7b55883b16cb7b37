"""Work that must not grow faster than its input: dealt paths, slices of batches, spread postings."""

import io
import tracemalloc
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from filelake import session
from filelake.operators import index, text
from filelake.sources import objects


def test_lists_of_paths_are_staged_in_few_files(spark):
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(400).select(F.concat(F.lit("/p"), F.col("id").cast("string")).alias("path")).repartition(200)
    dealt = session.spread_paths(many)
    assert len(dealt.inputFiles()) <= session.PARTS_PER_CORE * cores
    assert {r.path for r in dealt.collect()} == {f"/p{i}" for i in range(400)}


def test_objects_are_listed_in_few_parts(spark, tmp_path):
    for i in range(1500):
        (tmp_path / f"{i}.txt").write_bytes(b"x")
    listed = objects.list_objects(spark, str(tmp_path))
    assert listed.count() == 1500
    assert listed.rdd.getNumPartitions() <= session.PARTS_PER_CORE * spark.sparkContext.defaultParallelism


def test_the_driver_does_not_hold_a_listing(spark, tmp_path):
    """Entries of a folder are rows that tasks make, the same as those of Spark's listing, which is a list of files on the driver."""
    for name in ("a.txt", "b c.txt", "s/t/u", "_a=b", "_g=1/m", "_x", "_metadata", ".h", ".e/k", "_d/k", "z._COPYING_", "none/.x"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"xx")
    (tmp_path / "empty").write_bytes(b"")
    for i in range(300):
        (tmp_path / "s" / f"{i}.txt").write_bytes(b"x" * (i + 1))
    listed = objects.list_objects(spark, str(tmp_path))
    by_spark = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path)).select("path", "length")
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, by_spark.collect()))
    assert listed.count() == 305 and listed.dtypes == by_spark.dtypes
    assert len(listed.inputFiles()) < 100 < len(by_spark.inputFiles())
    assert not objects.list_objects(spark, str(tmp_path / "none")).collect()


def test_members_of_an_archive_share_tasks(spark, tmp_path, monkeypatch):
    """Runs of members go to a task together, so that an archive is not opened again for every member."""
    rows = []
    for a in range(3):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as out:
            for i in range(300):
                out.writestr(f"d/{a}-{i}.txt", f"text {a} {i}")
        path = tmp_path / f"{a}.zip"
        path.write_bytes(buffer.getvalue())
        rows.append((str(path),))
    dealt = []
    spread = session.spread_paths
    monkeypatch.setattr(objects, "spread_paths", lambda df, *by: dealt.append(spread(df, *by)) or dealt[-1])
    found = objects.zip_members(spark.createDataFrame(rows, "path string")).collect()
    assert len(found) == 900 and not [r for r in found if r.error]
    assert {r.n_bytes for r in found if r.inner_path == "d/2-299.txt"} == {len("text 2 299")}
    tasks = dealt[1].select("path", F.spark_partition_id().alias("part")).distinct().groupBy("path").count().collect()
    assert [r["count"] for r in tasks if r["count"] > -(-300 // session.PATHS_PER_TASK)] == []


def test_parts_cover_all_rows():
    sizes = np.array([3, 0, 4, 9, 1, 1, 0])
    batch = pa.record_batch([pa.array(range(len(sizes)))], ["n"])
    cut = [p.column("n").to_pylist() for p in text.parts(batch, sizes, 5)]
    assert [n for p in cut for n in p] == list(range(len(sizes)))
    assert all(sizes[p].sum() <= 5 or len(p) == 1 for p in cut)
    assert list(text.parts(batch.slice(0, 0), sizes[:0], 5)) == []


def test_counts_do_not_grow_with_the_batch():
    docs, words = 4000, 1000
    rng = np.random.default_rng(1)
    toks = pa.DictionaryArray.from_arrays(
        pa.array(rng.integers(0, 5000, docs * words, dtype=np.int32)), pa.array([f"w{i}" for i in range(5000)])
    ).cast(pa.string())
    lists = pa.ListArray.from_arrays(pa.array(np.arange(docs + 1, dtype=np.int32) * words), toks)
    batch = pa.record_batch([pa.array(range(docs)), pa.array([words] * docs), lists], ["doc_id", "dl", "toks"])
    tracemalloc.start()
    n = total = 0
    for out in index._counts(iter([batch])):
        n += out.num_rows
        total += sum(out.column("tfs").flatten().to_pylist())
        del out
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (n, total) == (docs, docs * words)
    # Eight bytes for each of the batch's words, of which the work needs several copies.
    assert peak < 8 * docs * words * 1.5, peak


def test_workers_get_large_rows_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    rows = spark.range(0, 1000, 1, 1).select(F.repeat(F.lit("x"), 50_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows])], ["n"])

    assert max(r.n for r in rows.mapInArrow(sizes, "n bigint").collect()) == 1000
    with session.small_batches(spark):
        found = [r.n for r in rows.mapInArrow(sizes, "n bigint").collect()]
    assert sum(found) == 1000 and max(found) * 50_000 <= 2 * session.BATCH_BYTES
    assert spark.conf.get(key) == before


def test_index_holds_few_blocks_at_once(spark, tmp_path, monkeypatch):
    """Blocks are large rows: their row groups are small, and each job over them hands small batches to the workers."""
    monkeypatch.setattr(session, "SPREAD_BYTES_PER_CORE", 0)
    monkeypatch.setattr(index, "GROUP_BYTES", 1)
    key, held = "spark.sql.execution.arrow.maxBytesPerBatch", []
    monkeypatch.setattr(index, "stage", lambda df, label: held.append((label, spark.conf.get(key))) or session.stage(df, label))
    store = index.IndexJob._store
    monkeypatch.setattr(index.IndexJob, "_store", lambda job, *a: held.append(("segment", spark.conf.get(key))) or store(job, *a))
    docs = session.stage(spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b"), F.col("id")).alias("text")), "docs")
    job = index.IndexJob(spark, str(tmp_path / "index"), block_docs=1)
    job.run(docs)
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "index" / "segment-0").glob("*.parquet")]
    assert sum(f.num_rows for f in files) == 400
    assert all(f.row_group(g).num_rows <= 100 for f in files for g in range(f.num_row_groups))
    queries = spark.createDataFrame([(1, "a b7", 2), (2, "none", 2)], "query_id bigint, text string, k bigint")
    assert [tuple(r) for r in job.page(queries).where("rank = 1").select("query_id", "doc_id").collect()] == [(1, 7)]
    assert sorted(map(tuple, job.matching(queries).collect())) == [(1, 400), (2, 0)]
    assert {"segment", "headers", "matching"} <= {label for label, _ in held}
    assert {size for _, size in held} == {str(session.BATCH_BYTES)}


def test_postings_move_the_texts_only(spark, monkeypatch):
    """Also on input too large to be dealt out as a whole, postings themselves are not shuffled."""
    monkeypatch.setattr(session, "SPREAD_BYTES_PER_CORE", 0)
    docs = session.stage(spark.createDataFrame(
        [(1, "a b a"), (2, None), (3, "B c"), (3, "B c"), (3, "z"), (None, "a")], "doc_id bigint, text string"
    ), "docs")
    made = text.postings(docs)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Exchange hashpartitioning(doc_id" in plan
    rows = sorted(tuple(r) for r in made.where("doc_id is not null").select("term", "doc_id", "tf", "dl").collect())
    assert rows == [("a", 1, 2, 3), ("b", 1, 1, 3), ("b", 3, 2, 2), ("c", 3, 2, 2), ("z", 3, 1, 1)]
    assert made.where("doc_id is null").count() == 1


def test_plain_source_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    from feeds import change, frame

    from filelake.plans import table_queries

    spark.createDataFrame([(1, "t", "en", 1)], "doc_id bigint, text string, lang string, n_chars bigint").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    feed = frame(spark, [change(i, "file", f"/d/f{i}.jpg", f"i{i}", "r") for i in range(64)])
    wrote = []
    monkeypatch.setattr(table_queries, "new_folder", lambda s, label: wrote.append(str(tmp_path / label)) or wrote[-1])
    table_queries._source_files(spark, str(tmp_path), feed, str(tmp_path / "source"))
    made = spark.read.parquet(wrote[0])
    assert made.count() == 64 and len(list((tmp_path / "source" / "d").iterdir())) == 64
    with_files = made.select(F.input_file_name().alias("f")).distinct().count()
    assert with_files > 1
