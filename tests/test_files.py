"""ZIP files, digests, sidecars and state tables on disk."""

import hashlib
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filelake import schemas
from filelake.functions import paths as P
from filelake.operators import imports
from filelake.sources import objects, sidecar
from filelake.sources.state import StateTable

_KEYED = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


@pytest.fixture
def archives(spark, tmp_path):
    def build(name, members, spoil=False):
        path = tmp_path / name
        with zipfile.ZipFile(path, "w") as out:
            for inner, content in members:
                out.writestr(inner, content)
        if spoil:
            raw = bytearray(path.read_bytes())
            at = raw.find(b"spoiled")
            raw[at] ^= 255
            path.write_bytes(raw)

    build("good.zip", [("a/x.jpg", b"one"), ("a/", b""), ("__MACOSX/a/x.jpg", b"no"), ("a/.h.pdf", b"no"),
                       ("b.PDF", b"two"), ("in.zip", b"nested"), ("run.exe", b"no"), ("b.PDF", b"again")])
    build("empty.zip", [])
    build("part.zip", [("ok.txt", b"fine"), ("bad.txt", b"spoiled")], spoil=True)
    (tmp_path / "corrupt.zip").write_bytes(b"nope")
    return objects.list_objects(spark, str(tmp_path), "*.zip")


def test_zip_members(archives):
    rows = objects.zip_members(archives).withColumn("zip_id", P.uri_id(F.col("path"))).collect()
    good = {(r.inner_path, r.category, r.n_bytes, r.sha256) for r in rows if r.zip_id == "good"}
    digest = lambda b: hashlib.sha256(b).hexdigest()
    assert good == {("a/x.jpg", "images", 3, digest(b"one")), ("b.PDF", "docs", 3, digest(b"two")),
                    ("b.PDF", "docs", 5, digest(b"again"))}
    part = {r.inner_path: (r.n_bytes, r.error is None) for r in rows if r.zip_id == "part"}
    assert part == {"ok.txt": (4, True), "bad.txt": (None, False)}
    assert not [r for r in rows if r.zip_id in ("corrupt", "empty")]


def test_corrupt_archive_is_reported(archives):
    rows = objects.zip_entries(archives).withColumn("zip_id", P.uri_id(F.col("path"))).where(F.col("error").isNotNull()).collect()
    assert [r.zip_id for r in rows] == ["corrupt"]
    assert "BadZipFile" in rows[0].error


def test_digests_isolate_a_missing_object(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"x" * 10)
    paths = spark.createDataFrame([(f"file://{tmp_path}/a.bin",), (f"file://{tmp_path}/gone.bin",)], "path string")
    rows = {r.path[-5:]: r for r in objects.digests(paths).collect()}
    assert rows["a.bin"].sha256 == hashlib.sha256(b"x" * 10).hexdigest()
    assert rows["e.bin" if "e.bin" in rows else "n.bin"].error


def test_unpack_and_mirror(spark, archives, tmp_path):
    members = objects.zip_members(archives).where("inner_path <> 'b.PDF'")
    target = F.concat(F.lit(f"{tmp_path}/out/"), F.replace("inner_path", F.lit("/"), F.lit("_")))
    done = objects.unpack(members.withColumn("target", target)).collect()
    assert {r.inner_path: r.n_bytes for r in done} == {"a/x.jpg": 3, "ok.txt": 4, "bad.txt": None}
    assert (tmp_path / "out" / "a_x.jpg").read_bytes() == b"one"
    copies = spark.createDataFrame([(f"{tmp_path}/out/a_x.jpg", f"{tmp_path}/m/d/x"), ("/none", f"{tmp_path}/m/y")],
                                   "source string, target string")
    rows = {r.source[-1]: (r.n_bytes, r.error is None) for r in objects.mirror(copies).collect()}
    assert rows == {"g": (3, True), "e": (None, False)}
    assert (tmp_path / "m" / "d" / "x").read_bytes() == b"one"


def test_manifest_names_the_archive(archives):
    named = archives.withColumn("file_id", F.lit("Z"))
    rows = objects.manifest(named).where("error is null").collect()
    assert {(r.file_id, r.inner_path) for r in rows} >= {("Z", "a/x.jpg"), ("Z", "in.zip")}


def test_missing_sidecar_folder_is_empty(spark, tmp_path):
    assert sidecar.read_sidecars(spark, str(tmp_path / "none")).count() == 0


def test_sidecar_category_is_a_partition(spark, tmp_path):
    row = ("A", "/a.jpg", "r1", "image/jpeg", 3 * 1024**3, "2024-01-01 00:00:00", "images", "u", "a.jpg", None, None)
    meta = spark.createDataFrame([row], schemas.FILE_META)
    sidecar.write_sidecars(meta, str(tmp_path / "m"))
    back = sidecar.read_sidecars(spark, str(tmp_path / "m"))
    assert back.select(*schemas.FILE_META.fieldNames()).collect() == meta.collect()
    plan = back.where(F.col("category") == "images")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category" in plan


def test_state_versions(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "s"), "file_id", schemas.REV_INDEX)
    rows = lambda *r: spark.createDataFrame(list(r), "file_id string, rev string, removed boolean")
    state = lambda **kw: {r.file_id: r.rev for r in table.read(**kw).collect()}
    assert state() == {}
    table.write(0, rows(("A", "r1", False), ("B", "r1", False)))
    table.write(1, rows(("A", "r2", False), ("B", "r1", True), ("C", "r1", False)))
    assert state() == {"A": "r2", "C": "r1"}
    assert state(upto=0) == {"A": "r1", "B": "r1"}
    # Writing a version again replaces it.
    table.write(1, rows(("A", "r3", False)))
    assert state() == {"A": "r3", "B": "r1"}
    table.compact()
    assert state() == {"A": "r3", "B": "r1"}
    table.write(2, rows(("B", None, True)))
    assert state() == {"A": "r3"}
    # A version without its commit marker does not count.
    table.write(3, rows(("A", "r9", False)))
    (tmp_path / "s" / "delta-3" / "_SUCCESS").rename(tmp_path / "s" / "delta-3" / "_broken")
    assert state() == {"A": "r3"}


def test_row_index_and_batches(spark):
    uris = spark.createDataFrame([(f"u{i:05d}",) for i in range(1003)], "uri string").repartition(7)
    numbered = imports.row_index(uris, "uri").collect()
    assert {r.uri: r.idx for r in numbered} == {f"u{i:05d}": i for i in range(1003)}
    batches = sorted(imports.batches(uris, 100).collect(), key=lambda r: r.batch_id)
    assert [len(b.uris) for b in batches] == [100] * 10 + [3]
    assert [u for b in batches for u in b.uris] == [f"u{i:05d}" for i in range(1003)]


def test_import_results(spark):
    bodies = [(1, 50, '{"done":false,"name":"op1"}'), (2, 50, '{"error":{"message":"quota"}}'),
              (3, 50, '{"done":true,"metadata":{"successCount":"48","failureCount":"2"}}'), (4, 7, '{"done":true}'),
              (5, 0, "{}"), (6, 9, None), (7, 50, '{"done":true,"metadata":{"failureCount":"3"}}')]
    df = imports.normalize(spark.createDataFrame(bodies, "op_id bigint, n_uris bigint, body string"))
    assert {r.op_id: (r.success, r.failed) for r in df.collect()} == {
        1: (50, 0), 2: (0, 50), 3: (48, 2), 4: (7, 0), 5: (0, 0), 6: (0, 9), 7: (50, 3)
    }
    assert imports.import_totals(df).first() == (155, 64)


def test_old_versions_are_forgotten(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "t"), "k", _KEYED)
    for n in range(7):
        table.write(n, spark.createDataFrame([(f"k{n % 3}", n)], _KEYED))
        if n % 2:
            table.compact()
    assert {r.k: r.v for r in table.read().collect()} == {"k0": 6, "k1": 4, "k2": 5}
    # The last two snapshots and what came after the first of them.
    assert table.versions() == [(3, True), (4, False), (5, False), (5, True), (6, False)]


def test_many_sidecars_are_opened_by_tasks(spark, tmp_path, monkeypatch):
    """The same rows as by Spark's reader, without a list of all files on the driver."""
    fields = '{"file_id":"i%d","path":"/p/\u00fc %d","rev":"r1","size":%d,"category":"docs"}'
    (tmp_path / "m" / "below").mkdir(parents=True)
    for i in range(200):
        (tmp_path / "m" / f"i{i}.json").write_text(fields % (i, i, i), encoding="utf-8")
    (tmp_path / "m" / "two.json").write_text("\n" + fields % (300, 1, 1) + "\r\n" + '{"file_id": "x", "size": "wrong"}' + "\nno json\n")
    (tmp_path / "m" / ".hidden.json").write_text(fields % (400, 1, 1))
    (tmp_path / "m" / "below" / "i.json").write_text(fields % (500, 1, 1))
    usual = sidecar.read_sidecars(spark, str(tmp_path / "m"))
    monkeypatch.setattr(sidecar, "MANY", 100)
    opened = sidecar.read_sidecars(spark, str(tmp_path / "m"))
    key = lambda r: tuple(map(str, r))
    assert sorted(opened.collect(), key=key) == sorted(usual.collect(), key=key)
    assert opened.dtypes == usual.dtypes and opened.count() == 203
    assert len(opened.inputFiles()) < 100 < len(usual.inputFiles())


def test_tasks_write_in_hidden_folders_of_their_own(tmp_path):
    """New names in a shared folder are not waited for; nothing but the objects is left, also after an error."""
    class Broken:
        def read(self, n):
            raise OSError("broken")

    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "kept").write_bytes(b"old")
    with objects.Writer() as write, objects.Writer() as other:
        for i in range(3):
            assert write.put(str(tmp_path / "a" / f"{i}"), b"x" * i) == i
            other.put(str(tmp_path / "a" / f"o{i}"), b"o")
        with pytest.raises(OSError):
            write.store(Broken(), str(tmp_path / "a" / "kept"))
        hidden = [p for p in (tmp_path / "a").iterdir() if p.name.startswith(".")]
        assert len(hidden) == 2 and all(p.is_dir() and not list(p.iterdir()) for p in hidden)
    assert sorted(p.name for p in (tmp_path / "a").iterdir()) == ["0", "1", "2", "kept", "o0", "o1", "o2"]
    assert (tmp_path / "a" / "kept").read_bytes() == b"old"
