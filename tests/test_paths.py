import os
import random

from pyspark.sql import functions as F

from filelake import constants as C
from filelake.functions import paths as P


def column(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", make(F.col("v"))).orderBy("i").collect()]


def test_extension_follows_splitext(spark):
    rng = random.Random(5)
    names = ["".join(rng.choice("a.B/x~\n é") for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    names += [".pdf", "..jpg", "a.", "a.tar.gz", "d.x/file", "a/.hidden"]
    assert column(spark, names, P.raw_extension) == [os.path.splitext(n)[1] for n in names]
    assert column(spark, [".pdf", "..jpg", "a.", "a.tar.GZ"], P.extension) == ["", "", ".", ".gz"]


def test_types_and_keys(spark):
    names = ["a.JPG", "b.pdf", "c.mov", "d.exe", "e", None]
    assert column(spark, names, P.category) == ["images", "docs", "media", None, None, None]
    assert column(spark, names, P.mime_type)[:4] == ["image/jpeg", "application/pdf", "video/quicktime", C.DEFAULT_MIME]
    key = lambda c: P.object_key(P.category(c), F.lit("X1"), P.extension(c))
    assert column(spark, names[:4], key) == ["mirror/images/X1", "mirror/docs/X1.pdf", "mirror/media/X1", None]


def test_clean_id(spark):
    assert column(spark, ["id:A", "id:id:A", "A", "", None], P.clean_id) == ["A", "A", "A", "", None]


def test_member_document_keeps_its_extension_twice(spark):
    ident = column(spark, ["a/report.PDF"], lambda c: P.member_id(F.lit("Z"), c))
    assert ident == ["Z___a_report.PDF"]
    key = lambda c: P.object_key(F.lit("docs"), P.member_id(F.lit("Z"), c), P.extension(c))
    assert column(spark, ["a/report.PDF"], key) == ["mirror/docs/Z___a_report.PDF.pdf"]


def test_archive_parents_equal_prefix_join(spark):
    paths = ["/a.zip!/x", "/a.zip!/b.zip!/y", "/a.zip", "/d!/x", "/d!/a.zip!/x", "/p/q", "/a.zip!/"]
    found = column(spark, paths, P.archive_parents)
    zips = {p for row in found for p in row} | {"/a.zip", "/d!/a.zip"}
    for path, parents in zip(paths, found):
        assert sorted(parents) == sorted(z for z in zips if path.startswith(z + "!/"))


def test_uri_id(spark):
    uris = ["lake://b/mirror/docs/A1.pdf", "lake://b/mirror/docs/A.b.TXT", "lake://b/mirror/docs/A1"]
    assert column(spark, uris, P.uri_id) == ["A1", "A.b", "A1"]


def test_member_visibility(spark):
    names = ["a/", "__MACOSX/a.jpg", "a/.h.jpg", ".h", "a/b.jpg", "b.jpg", "a.d/__MACOSX"]
    assert column(spark, names, P.member_visible) == [False, False, False, False, True, True, True]
