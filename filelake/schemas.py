"""Row types of the feed, the catalog, the state tables and the responses."""

from pyspark.sql import types as T

CHANGE = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("raw_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("path_display", T.StringType()),
    T.StructField("path_lower", T.StringType()),
    T.StructField("rev", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("server_modified", T.TimestampNTZType()),
])

# Sidecar of a plain file, an archive member (source_zip set) or an archive (extracted_count set).
FILE_META = T.StructType([
    T.StructField("file_id", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("rev", T.StringType()),
    T.StructField("mime_type", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("server_modified", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("object_uri", T.StringType()),
    T.StructField("caption", T.StringType()),
    T.StructField("source_zip", T.StringType()),
    T.StructField("extracted_count", T.LongType()),
])

PATH_INDEX = T.StructType([
    T.StructField("path_lower", T.StringType()),
    T.StructField("file_id", T.StringType()),
])
REV_INDEX = T.StructType([
    T.StructField("file_id", T.StringType()),
    T.StructField("rev", T.StringType()),
])
# Stored text index: documents and words of a segment, those of them that later imports ended, and the
# first version whose ended documents may lie in it.
SEGMENT = T.StructType([
    T.StructField(name, T.LongType()) for name in ("segment", "n_docs", "sum_dl", "n_gone", "gone_dl", "gone_from")
])
SYNC_STATE = T.StructType([T.StructField("cursor", T.LongType())])

DATAPOINT = T.StructType([
    T.StructField("datapoint_id", T.StringType()),
    T.StructField("feature_vector", T.ArrayType(T.FloatType())),
    T.StructField("restricts", T.ArrayType(T.StructType([
        T.StructField("namespace", T.StringType()),
        T.StructField("allow_list", T.ArrayType(T.StringType())),
    ]))),
])

NEIGHBOR_RESPONSE = (
    "nearestNeighbors array<struct<neighbors array<struct<"
    "datapoint struct<datapointId string>, distance double>>>>"
)
SEARCH_RESPONSE = (
    "results array<struct<document struct<id string, derivedStructData struct<"
    "title string, link string, snippets array<struct<snippet string>>>>>>, totalSize bigint"
)
IMPORT_RESPONSE = (
    "done boolean, error struct<message string>, "
    "metadata struct<successCount string, failureCount string>"
)
