"""Versioned state tables: plain parquet folders with a commit marker per version.

A version is either a full snapshot or a delta of changed keys. Reading folds the newest full
snapshot with the deltas after it, so a batch writes what it changed and not the whole state.
Writing a version again overwrites it, which makes a repeated batch harmless.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filelake.operators import skew
from filelake.session import remove


@dataclass(frozen=True)
class StateTable:
    """``schema`` holds the key and the values; a row with ``removed`` set deletes its key."""

    spark: SparkSession
    root: str
    key: str
    schema: T.StructType

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("removed", T.BooleanType())])

    def _folder(self, version: int, full: bool) -> str:
        return f"{self.root}/{'full' if full else 'delta'}-{version}"

    def versions(self) -> list[tuple[int, bool]]:
        """Committed versions as ``(version, full)``, oldest first; lists folder names only."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        # One call for all versions: the markers' own paths name them.
        marks = fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, "{full,delta}-*/_SUCCESS")) or []
        names = [m.getPath().getParent().getName().partition("-") for m in marks]
        return sorted((int(number), kind == "full") for kind, _, number in names)

    def write(self, version: int, rows: DataFrame, full: bool = False) -> None:
        if "removed" not in rows.columns:
            rows = rows.withColumn("removed", F.lit(False))
        columns = self._stored().fieldNames()
        # The job commit adds _SUCCESS last: a version is either whole or not there.
        rows.select(*columns).write.mode("overwrite").parquet(self._folder(version, full))

    def read_version(self, version: int) -> DataFrame:
        """What one delta version holds."""
        return self.spark.read.schema(self._stored()).parquet(self._folder(version, False))

    def read(self, upto: int | None = None) -> DataFrame:
        """State as of version ``upto``, by default the newest."""
        found = [v for v in self.versions() if upto is None or v[0] <= upto]
        base = max((v for v, full in found if full), default=None)
        parts = [(v, full) for v, full in found if base is None or (full and v == base) or (not full and v > base)]
        columns = self.schema.fieldNames()
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = None
        for version, full in parts:
            part = self.spark.read.schema(self._stored()).parquet(self._folder(version, full))
            part = part.withColumn("_version", F.lit(version).cast("bigint"))
            rows = part if rows is None else rows.unionByName(part)
        if len(parts) > 1:
            rows = skew.latest(rows, self.key, "_version")
        return rows.where(~F.col("removed")).select(*columns)

    def compact(self, after: int = 1) -> None:
        """Fold the deltas into a full snapshot of the newest version, if there are ``after`` of them.

        A table that is written whole every time only loses what no read needs any more.
        """
        found = self.versions()
        base = max((v for v, full in found if full), default=-1)
        if sum(not full and v > base for v, full in found) >= after:
            self.write(found[-1][0], self.read(), full=True)
            self._forget()
        elif sum(full for _, full in found) > max(2, after):
            self._forget()

    def _forget(self) -> None:
        """Remove what only reads of versions before the last two snapshots would need."""
        found = self.versions()
        keep = sorted((v for v, full in found if full), reverse=True)[:2]
        if len(keep) == 2:
            for version, full in found:
                if version < keep[1] or (version == keep[1] and not full):
                    remove(self.spark, self._folder(version, full))
