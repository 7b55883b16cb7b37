"""Change feed: baseline and incremental reads, and the cursor between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelake import schemas


def read_feed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Whole feed, deletions included. ``seq`` gives the order; files carry none."""
    return spark.read.schema(schemas.CHANGE).format(fmt).load(path)


def since(changes: DataFrame, cursor) -> DataFrame:
    """Events after ``cursor``: a number, or a one-row one-column DataFrame read as scalar subquery."""
    bound = cursor.scalar() if isinstance(cursor, DataFrame) else F.lit(cursor)
    return changes.where(F.col("seq") > bound)


def advance(changes: DataFrame, saved: DataFrame) -> DataFrame:
    """Mode of the next run, its events, and the cursor to save at its end.

    ``saved`` is the sync state table; without a cursor the run is a baseline over the whole feed.
    """
    old = saved.agg(F.max("cursor")).scalar()
    new = F.coalesce(F.col("seq") > old, F.lit(True))
    seen = changes.agg(F.count_if(new).alias("n_events"), F.max("seq").alias("last"))
    return seen.select(
        F.when(old.isNull(), "baseline").otherwise("incremental").alias("mode"),
        old.alias("old_cursor"),
        "n_events",
        F.coalesce("last", old).alias("new_cursor"),
    )
