"""Tokens, hashed features and titles as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order, over the whole text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def plain(text: Column) -> Column:
    """``text`` as ``operators.text.split_terms`` takes it, which knows the letters and digits of ASCII: unchanged if there
    are no others, else in lower case and with spaces for what is beyond ASCII and part of no token."""
    ascii_only = F.is_valid_utf8(text) & (F.octet_length(text) == F.char_length(text))
    return F.when(ascii_only, text).otherwise(F.regexp_replace(F.lower(text), r"[^\x00-\x7F\p{L}\p{N}]+", " "))


def term_bucket(term: Column, dim: int) -> Column:
    """Feature-hash bucket of a term: leading 32 bits of its md5, modulo ``dim``."""
    head = F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("bigint")
    return head % F.lit(dim)


def html_title(html: Column) -> Column:
    """Text of the first ``<title>``, null if there is none or it is empty."""
    title = F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
    return F.when(title != "", title)


def each(rows: DataFrame, keep: list[str], array: Column, name: str) -> DataFrame:
    """One row per element of ``array``.

    A plain explode makes Catalyst filter on the array's size below it, which would compute a
    costly array twice; the outer form does not.
    """
    return rows.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())
