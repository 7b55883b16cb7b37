"""Checks over the catalog and its indexes, as report rows ``check, value, passed``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filelake.operators.catalog import percent


def _report(one_row: DataFrame, rules: dict[str, bool | None]) -> DataFrame:
    """Turn a one-row aggregate into rows; a rule says whether a value must be positive or zero."""
    rows = one_row.unpivot([], list(rules), "check", "value")
    positive = [n for n, must in rules.items() if must is True]
    zero = [n for n, must in rules.items() if must is False]
    passed = (
        F.when(F.col("check").isin(positive), F.col("value") > 0)
        .when(F.col("check").isin(zero), F.col("value") == 0)
        .otherwise(F.lit(True))
    )
    return rows.withColumn("passed", passed)


def mirror_report(meta: DataFrame, state_paths: DataFrame) -> DataFrame:
    """Objects per kind, sidecars and indexed paths; images or documents must be there."""
    counted = meta.agg(
        *[F.count_if(F.col("category") == c).alias(c) for c in ("images", "docs", "media")],
        F.count_if(F.col("category").isin("images", "docs")).alias("images_or_docs"),
        F.count(F.lit(1)).alias("sidecars"),
    )
    paths = state_paths.agg(F.count(F.lit(1)).alias("n")).scalar()
    return _report(
        counted.withColumn("paths", paths),
        {"images": None, "docs": None, "media": None, "images_or_docs": True, "sidecars": True, "paths": True},
    )


def embedding_report(images: DataFrame, state: DataFrame) -> DataFrame:
    """Images, how many of them are embedded at their revision, stale state rows, coverage."""
    held = state.select("file_id", F.col("rev").alias("held"), F.lit(True).alias("known"))
    both = images.select("file_id", "rev", F.lit(True).alias("here")).join(held, "file_id", "full_outer")
    here = F.col("here").isNotNull()
    done = F.count_if(here & (F.col("rev") == F.col("held")))
    return both.agg(
        F.count_if(here).alias("images"),
        done.alias("embedded"),
        F.count_if(here & F.col("known").isNotNull() & (F.col("rev") != F.col("held"))).alias("outdated"),
        F.count_if(~here).alias("stale"),
        percent(done, F.count_if(here)).alias("coverage"),
    )


def integrity_report(path_index: DataFrame, rev_index: DataFrame, meta: DataFrame) -> DataFrame:
    """Rows of one index that the other one lacks; all counts must be zero."""

    def lacking(left: DataFrame, right: DataFrame):
        gone = left.select("file_id").join(right.select("file_id"), "file_id", "left_anti")
        return gone.agg(F.count(F.lit(1)).alias("n")).scalar()

    one = path_index.sparkSession.range(1).select(
        lacking(path_index, meta).alias("paths_without_meta"),
        lacking(rev_index, meta).alias("revs_without_meta"),
        lacking(meta, path_index).alias("meta_without_path"),
        lacking(meta, rev_index).alias("meta_without_rev"),
        meta.where(F.col("category").isNull()).agg(F.count(F.lit(1))).scalar().alias("meta_without_category"),
    )
    return _report(one, dict.fromkeys(one.columns, False))
