"""Incremental embedding run: plan, encode what is pending, update the vector and state tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelake import schemas
from filelake.operators import vectors
from filelake.session import small_side, stage
from filelake.sources.state import StateTable


@dataclass(frozen=True)
class EmbedJob:
    """Keeps ``state`` (id and embedded revision) and ``points`` (datapoints) below ``root``.

    A run writes one version of both: new vectors and the removal of stale ones, never the whole
    tables. The state is written last, so a run that broke off is repeated as a whole. An image
    that fails is counted and left out of the state, so the next run tries it again.
    """

    spark: SparkSession
    root: str
    make_encoder: Callable[[], Callable[[bytes], np.ndarray]]
    dim: int
    # Versions after which the tables are folded into a snapshot.
    compact_after: int = 24

    @property
    def state(self) -> StateTable:
        return StateTable(self.spark, f"{self.root}/state", "file_id", schemas.REV_INDEX)

    @property
    def points(self) -> StateTable:
        return StateTable(self.spark, f"{self.root}/points", "datapoint_id", schemas.DATAPOINT)

    def run(self, images: DataFrame, contents: DataFrame) -> DataFrame:
        """Embed ``images`` ``(file_id, rev, size)`` from ``contents``.

        ``contents`` is ``(file_id, uri)``, then only the objects that are pending are opened, or
        ``(file_id, content)`` if the bytes are in a table.

        Returns the counters ``(outcome, n)`` of embedded, skipped, removed and errors.
        """
        version = max((v for v, _ in self.state.versions()), default=-1) + 1
        plan = stage(vectors.embed_plan(images, self.state.read(version - 1)), "embed-plan")
        todo = small_side(plan.where(F.col("action") == "embedded").select("file_id", "rev"), "pending")
        value = "uri" if "uri" in contents.columns else "content"
        found = contents.select("file_id", value).join(todo, "file_id")
        done = stage(vectors.encode_batch(found, self.make_encoder, self.dim), "encoded")
        good = done.where(F.col("error").isNull())
        gone = plan.where(F.col("action") == "removed").select("file_id", F.lit(True).alias("removed"))
        new = good.select(
            F.col("file_id").alias("datapoint_id"), "feature_vector",
            vectors.category_restrict().alias("restricts"), F.lit(False).alias("removed"),
        )
        self.points.write(version, new.unionByName(
            gone.withColumnRenamed("file_id", "datapoint_id"), allowMissingColumns=True
        ))
        self.state.write(version, good.select("file_id", "rev", F.lit(False).alias("removed")).unionByName(
            gone, allowMissingColumns=True
        ))
        for table in (self.points, self.state):
            table.compact(self.compact_after)
        # An image without an object is an error as well.
        marked = plan.join(good.select("file_id", F.lit(True).alias("good")), "file_id", "left")
        outcome = (
            F.when(F.col("action") == "skipped_size", "skipped")
            .when((F.col("action") == "embedded") & F.col("good").isNull(), "errors")
            .otherwise(F.col("action"))
        )
        return marked.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
