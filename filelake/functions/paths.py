"""Names, paths, keys and file types as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filelake import constants as C

# The last ".suffix" of the last path component; leading dots of a name do not start a suffix.
_SUFFIX = r"(?s)\A.*?[^./][^/]*(\.[^./]*)\z"


def _literal_map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs for x in pair])


def clean_id(raw_id: Column) -> Column:
    """Feed id without its ``id:`` marks; null and empty pass through."""
    return F.replace(raw_id, F.lit("id:"), F.lit(""))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def raw_extension(name: Column) -> Column:
    return F.regexp_extract(name, _SUFFIX, 1)


def extension(name: Column) -> Column:
    """Lower-cased extension with its dot, or the empty string."""
    return F.lower(raw_extension(name))


def category_of_ext(ext: Column) -> Column:
    """Category of an extension, null where the type is not supported."""
    return F.try_element_at(_literal_map((e, c) for e, c, _ in C.FILE_TYPES), ext)


def mime_of_ext(ext: Column) -> Column:
    known = F.try_element_at(_literal_map((e, m) for e, _, m in C.FILE_TYPES), ext)
    return F.coalesce(known, F.lit(C.DEFAULT_MIME))


def category(name: Column) -> Column:
    return category_of_ext(extension(name))


def mime_type(name: Column) -> Column:
    return mime_of_ext(extension(name))


def prefix(cat: Column) -> Column:
    return F.try_element_at(_literal_map(C.PREFIXES.items()), cat)


def object_key(cat: Column, file_id: Column, ext: Column) -> Column:
    """``prefix + id``, with the extension kept for documents only."""
    return F.concat(prefix(cat), file_id, F.when(cat == "docs", ext).otherwise(F.lit("")))


def meta_key(file_id: Column) -> Column:
    return F.concat(F.lit(C.META_PREFIX), file_id, F.lit(".json"))


def object_uri(root: str, key: Column) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), key)


def is_archive(name: Column) -> Column:
    return F.lower(name).endswith(".zip")


def member_id(zip_id: Column, inner_path: Column) -> Column:
    """Id of an archive member. Not injective: ``a/b`` and ``a_b`` share one id."""
    return F.concat(zip_id, F.lit("___"), F.replace(inner_path, F.lit("/"), F.lit("_")))


def member_path(zip_path: Column, inner_path: Column) -> Column:
    return F.concat(zip_path, F.lit("!/"), inner_path)


def member_visible(inner_path: Column) -> Column:
    """Neither a directory nor a resource-fork entry nor a hidden file."""
    return ~(
        inner_path.endswith("/")
        | inner_path.startswith("__MACOSX")
        | basename(inner_path).startswith(".")
    )


def uri_id(uri: Column) -> Column:
    """File id in an object URI: its base name without the extension."""
    name = basename(uri)
    return F.left(name, F.length(name) - F.length(raw_extension(name)))


def archive_parents(path: Column) -> Column:
    """All archive paths that ``path`` lies below: every prefix ending in ``.zip`` before ``!/``.

    A path below ``X.zip!/`` starts with that text, so this array turns a prefix join into an
    equi-join on the parent path.
    """
    parts = F.split(path, "!/", -1)
    cuts = F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1)))
    prefixes = F.transform(cuts, lambda n: F.array_join(F.slice(parts, 1, n), "!/"))
    return F.filter(prefixes, lambda p: p.endswith(".zip") & (p != path))


def whole_mib(size: Column) -> Column:
    return F.shiftright(size, 20)


def whole_gib(size: Column) -> Column:
    return F.shiftright(size, 30)


def time_text(ts: Column) -> Column:
    """Time as text for JSON: microseconds are written only when there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return F.when(F.date_trunc("second", ts) == ts, whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
