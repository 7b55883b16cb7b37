"""Inputs of the registered queries, derived with Spark from the given tables.

Every view uses all rows of its table. ``views.py`` says the same in SQL for the checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filelake import constants as C
from filelake.functions import paths as P
from filelake.operators import archive, imports, sync, vectors
from filelake.sources import feed

ROOT = "lake://main"
DIM = 64

# Extension of a file by its number modulo 17.
SLOTS = (
    ".bmp", ".pdf", ".mp3", ".zip", ".exe", ".jpg", ".docx", ".wav", ".PNG",
    ".xlsx", ".gif", ".pptx", ".txt", ".html", ".jpeg", ".mp4", ".mov",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slot(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(e) for e in SLOTS]), (number % 17 + 1).cast("int"))


def _feed(events: DataFrame, file_no: Column, path_no: Column) -> DataFrame:
    """Change feed over ``events``: ``file_no`` names the id, ``path_no`` the path."""
    ext = slot(path_no)
    name = F.concat(F.lit("F"), path_no.cast("string"), ext)
    folder = F.concat(F.lit("/Team"), (path_no % 7).cast("string"), F.lit("/"))
    kind = F.when(F.col("event_type") == "error", "deleted").when(F.col("event_type") == "view", "folder")
    scale = F.when(ext == ".zip", 64.0 * 3145728).otherwise(3145728.0)
    return events.select(
        F.col("event_id").alias("seq"),
        kind.otherwise("file").alias("kind"),
        F.concat(F.lit("id:"), file_no.cast("string")).alias("raw_id"),
        name.alias("name"),
        F.concat(folder, name).alias("path_display"),
        F.lower(F.concat(folder, name)).alias("path_lower"),
        F.concat(F.lit("r"), (F.col("event_id") % 3).cast("string")).alias("rev"),
        F.floor(F.col("value") * scale).cast("bigint").alias("size"),
        F.col("ts").alias("server_modified"),
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed in which path and id are paired: one file per user, one event per row."""
    return _feed(table(spark, sf_dir, "events"), F.col("user_id"), F.col("user_id"))


def moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed in which files move: the path also depends on the event's day and value."""
    events = table(spark, sf_dir, "events")
    path_no = F.col("user_id") + F.day("ts") % 2 + (F.col("value") > 400).cast("int")
    return _feed(events, F.col("user_id"), path_no.cast("bigint"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member manifest of the archives: each document is a member of one of four of them."""
    d = table(spark, sf_dir, "documents")
    stem = F.concat(F.lit("f"), (F.col("n_chars") % 1000).cast("string"), slot(F.col("n_chars")))
    number = F.col("doc_id").cast("string")
    inner = (
        F.when(F.col("doc_id") % 23 == 0, F.concat(F.lit("__MACOSX/"), number, F.lit(".png")))
        .when(F.col("doc_id") % 29 == 0, F.concat("source", F.lit("/.h"), number, F.lit(".png")))
        .when(F.col("doc_id") % 37 == 0, F.concat("source", F.lit("/d"), number, F.lit("/")))
        .when(F.col("lang") == "en", F.concat("source", F.lit("/"), stem))
        .otherwise(F.concat("source", F.lit("_"), stem))
    )
    return d.select(
        (3 + 17 * (F.col("doc_id") % 4)).cast("string").alias("file_id"),
        inner.alias("inner_path"),
        (F.col("n_chars") * 65536).alias("file_size"),
        F.col("doc_id").alias("pos"),
    )


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.fold_latest(changes(spark, sf_dir))


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sidecars of the live plain files."""
    return sync.file_meta(live(spark, sf_dir), ROOT)


def stored_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sidecars of everything in the mirror: the live plain files and the members of live archives."""
    inside = archive.expand(live_archives(spark, sf_dir), members(spark, sf_dir), ROOT)
    return meta(spark, sf_dir).unionByName(inside.drop("zip_id", "pos"), allowMissingColumns=True)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sidecars: the mirror's and the thin ones of the archives, which have no object."""
    heads = archive.archive_meta(live_archives(spark, sf_dir), members(spark, sf_dir))
    return stored_meta(spark, sf_dir).unionByName(heads, allowMissingColumns=True)


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of the mirror: key and length of each object, archive members included."""
    return stored_meta(spark, sf_dir).select(
        F.replace(F.col("object_uri"), F.lit(ROOT + "/"), F.lit("")).alias("object_key"),
        F.col("size").alias("length"), "file_id", "object_uri", "category",
    )


def rev_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisions on record: the first one seen of every file."""
    files = sync.enrich(changes(spark, sf_dir)).where(F.col("kind") == "file")
    return files.groupBy("file_id").agg(F.min_by("rev", "seq").alias("rev"))


def all_revs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisions on record with those of archive members, which have the one of their archive."""
    plain = rev_index(spark, sf_dir)
    inner = archive.visible_members(members(spark, sf_dir)).where(F.col("category").isNotNull())
    stored = inner.join(plain, "file_id").select(
        P.member_id(F.col("file_id"), F.col("inner_path")).alias("file_id"), "rev"
    )
    return plain.unionByName(stored.distinct())


def path_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every path a file was ever seen at, archive members included."""
    files = sync.enrich(changes(spark, sf_dir)).where(F.col("kind") == "file")
    plain = files.select("path_lower", "file_id").distinct()
    heads = files.where("archive").select(F.col("file_id").alias("zip_id"), "path_lower").distinct()
    inner = archive.visible_members(members(spark, sf_dir)).where(F.col("category").isNotNull())
    stored = inner.join(heads, inner["file_id"] == heads["zip_id"]).select(
        P.member_path(F.col("path_lower"), F.col("inner_path")).alias("path_lower"),
        P.member_id(F.col("zip_id"), F.col("inner_path")).alias("file_id"),
    )
    return plain.unionByName(stored.distinct())


def live_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live(spark, sf_dir).where("archive")


def previous_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursor of the run before: the last event before the feed's last day."""
    events = table(spark, sf_dir, "events")
    last_day = events.agg(F.max(F.date_trunc("day", "ts"))).scalar()
    return events.where(F.col("ts") < last_day).agg(F.max("event_id").alias("cursor"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image sidecars: one per embedding, with a revision from its label and a size."""
    e = table(spark, sf_dir, "embeddings")
    size = F.floor(F.abs(F.element_at("embedding", 1).cast("double")) * 167772160.0).cast("bigint")
    return e.select(
        F.col("vec_id").alias("file_id"), F.concat(F.lit("r"), (F.col("label") % 3).cast("string")).alias("rev"),
        size.alias("size"),
    )


def emb_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding state: what the labels table knows, images that are gone included."""
    lab = table(spark, sf_dir, "labels")
    return lab.select(
        F.col("doc_id").alias("file_id"),
        F.concat(F.lit("r"), (F.col("quality") + F.col("toxic")).cast("string")).alias("rev"),
    )


def datapoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("datapoint_id"), F.col("embedding").alias("feature_vector"), "label"
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    number = F.col("doc_id").cast("string")
    return d.select(
        "doc_id", "text", F.concat("source", F.lit("-"), number, F.lit(".txt")).alias("title"),
        F.concat(F.lit("mirror/docs/"), number, F.lit(".txt")).alias("link"),
    )


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query table: every benchmark text as a whole, five results each."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), "text", F.lit(C.COMBINED_TOP_K).cast("bigint").alias("k"))


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.text_vectors(queries(spark, sf_dir), "query_id", "text", DIM)


def doc_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object URI of every document; the key's number is padded so that URI order is id order."""
    d = table(spark, sf_dir, "documents")
    name = F.concat(F.lpad(F.col("doc_id").cast("string"), 12, "0"), slot(F.col("doc_id")))
    return d.select(F.concat(F.lit(ROOT + "/mirror/docs/"), name).alias("uri"), "doc_id", "n_chars")


def import_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer to each import batch of documents; its kind goes by the batch number."""
    numbered = imports.row_index(doc_uris(spark, sf_dir), "uri")
    per_batch = numbered.groupBy(F.floor(F.col("idx") / F.lit(C.IMPORT_BATCH)).alias("op_id")).agg(
        F.count(F.lit(1)).alias("n_uris"), F.count_if(F.col("n_chars") > 3000).alias("n_long"),
    )
    counts = F.struct(
        (F.col("n_uris") - F.col("n_long")).cast("string").alias("successCount"),
        F.col("n_long").cast("string").alias("failureCount"),
    )
    body = (
        F.when(F.col("op_id") % 6 == 0, F.to_json(F.struct(F.lit(False).alias("done"))))
        .when(F.col("op_id") % 6 == 1, F.to_json(F.struct(F.struct(F.lit("quota").alias("message")).alias("error"))))
        .when(F.col("op_id") % 6 == 2, F.to_json(F.struct(F.lit(True).alias("done"), counts.alias("metadata"))))
        .when(F.col("op_id") % 6 == 3, F.to_json(F.struct(F.lit(True).alias("done"))))
        .when(F.col("op_id") % 6 == 4, F.lit("{}"))
    )
    return per_batch.select("op_id", "n_uris", body.alias("body"))


def since_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.since(changes(spark, sf_dir), previous_cursor(spark, sf_dir))
