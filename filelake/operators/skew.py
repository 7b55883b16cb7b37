"""State carried along a key's history, also where one key holds much of the feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Longest history of one key that a single window group may hold.
MAX_GROUP = 1_000_000


def hot_keys(df: DataFrame, key: str, max_group: int) -> DataFrame:
    """Keys with more than ``max_group`` rows. At most ``rows / max_group`` of them exist.

    The count is combined map-side, so a hot key costs its counter only.
    """
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_group).select(key)


def with_previous(
    df: DataFrame,
    key: str,
    order: str,
    value: Column,
    name: str,
    max_group: int = MAX_GROUP,
    rows: int | None = None,
) -> DataFrame:
    """Add ``name``: the last non-null ``value`` of the same key strictly before this row.

    ``order`` must be a bigint that is unique within a key. Ordinary keys take one window over
    their rows. The history of a hot key is cut into spans of ``max_group`` order values: each span
    is its own window group, and what a span inherits comes from the one-row summaries of the spans
    before it. No group is longer than ``max_group`` rows, whatever the skew. Where ``df`` is known
    to have no more ``rows`` than that in all, there is nothing to look for.
    """
    if rows is not None and rows <= max_group:
        plain = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        return df.withColumn(name, F.last(value, ignorenulls=True).over(plain))
    # Bounded by rows / max_group keys, hence the broadcast. Where it turns out empty, adaptive
    # execution drops both joins and everything that feeds the second one.
    hot = F.broadcast(hot_keys(df, key, max_group).withColumn("_hot", F.lit(True)))
    of_span = F.floor(F.col(order) / F.lit(max_group)).cast("bigint")
    spans = df.join(hot, key, "left").withColumn("_span", F.when(F.col("_hot"), of_span))
    inside = W.partitionBy(key, "_span").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    local = spans.withColumn("_local", F.last(value, ignorenulls=True).over(inside))

    tails = (
        df.join(hot, key)
        .select(key, of_span.alias("_span"), F.col(order), value.alias("_value"))
        .groupBy(key, "_span")
        .agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(order))).alias("_tail"))
    )
    before = W.partitionBy(key).orderBy("_span").rowsBetween(W.unboundedPreceding, -1)
    carried = tails.withColumn("_carried", F.last("_tail", ignorenulls=True).over(before)).drop("_tail")

    joined = local.join(carried, [key, "_span"], "left")
    return joined.withColumn(name, F.coalesce("_local", "_carried")).select(*df.columns, name)


def latest(df: DataFrame, key, order: str | list[Column]) -> DataFrame:
    """Last row per key. The rank limit runs before the shuffle, so a hot key sends one row a task."""
    keys = [key] if isinstance(key, str) else list(key)
    by = [F.col(order).desc()] if isinstance(order, str) else order
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*by)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def top_k(df: DataFrame, key: str, by: list[Column], k: Column | int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per key with their 1-based ordinal.

    With an int ``k`` Spark limits each task to ``k`` rows per key before the shuffle.
    """
    ranked = df.withColumn(rank, F.row_number().over(W.partitionBy(key).orderBy(*by)))
    return ranked.where(F.col(rank) <= k)
