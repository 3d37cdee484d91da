"""Keyed upserts, versions and staged publication of Parquet tables without a table format.

A table is a folder of versions and of pointers. A write makes a new version, is read back, and
becomes the table by one more pointer, a single empty file whose name holds its number and the
version; the highest number counts. Nothing is deleted or renamed, so a job that fails at any
step leaves the last good version as the table.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_OWN_FOLDER: list[str] = []


def work_folder(spark: SparkSession) -> str:
    """Where derived tables go: below spark.checkpoint.dir, which all machines share. Where it is
    unset, a temporary folder serves a local session; a cluster is refused."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return f"{folder.rstrip('/')}/brontide"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    if not _OWN_FOLDER:
        _OWN_FOLDER.append(tempfile.mkdtemp(prefix="brontide-"))
    return _OWN_FOLDER[0]


def session_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below work_folder, which is deleted when the session's JVM ends."""
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


class VersionedTable:
    """Versions v1, v2 ... below a path, and pointers to the current one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, folder: str, pattern: str) -> list[tuple[int, ...]]:
        fs, p = self._fs(folder)
        if not fs.exists(p):
            return []
        found = (re.fullmatch(pattern, s.getPath().getName()) for s in fs.listStatus(p))
        return sorted(tuple(map(int, m.groups())) for m in found if m)

    def _pointers(self) -> list[tuple[int, ...]]:
        return self._names(f"{self.path}/pointers", r"(\d+)-v(\d+)")

    def current(self) -> int | None:
        pointers = self._pointers()
        return pointers[-1][1] if pointers else None

    def versions(self) -> list[int]:
        return [v for (v,) in self._names(self.path, r"v(\d+)")]

    def read(self, version: int | None = None) -> DataFrame:
        version = self.current() if version is None else version
        if not isinstance(version, int) or version < 1:
            raise ValueError(f"no such version: {version!r}")
        return self.spark.read.parquet(f"{self.path}/v{version}")

    def stage(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> int:
        """Writes a version of a number that none has had; it is not current yet."""
        version = max(self.versions(), default=0) + 1
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(f"{self.path}/v{version}")
        return version

    def swap(self, version: int) -> None:
        """Makes a version current."""
        number = self._pointers()[-1][0] + 1 if self._pointers() else 1
        fs, p = self._fs(f"{self.path}/pointers/{number:010d}-v{version}")
        fs.create(p, False).close()

    def upsert(self, new: DataFrame, key: list[str], partition: str | None = None) -> int:
        """Rows of new replace those of equal key; new must hold each key once. With a partition
        column that is part of the key only its affected values are joined and the others are
        copied; a key that can move is looked for in all partitions."""
        if not new.groupBy(*key).count().where("count > 1").isEmpty():
            raise ValueError(f"new rows repeat a key of {key}")
        by = (partition,) if partition else ()
        if self.current() is None:
            version = self.stage(new, by)
        else:
            old = self.read()
            if partition in key:
                touched = new.select(partition).distinct()
                same = old.join(touched, partition, "left_anti")
                kept = old.join(touched, partition, "left_semi").join(new.select(*key), key, "left_anti").unionByName(same)
            else:
                kept = old.join(new.select(*key), key, "left_anti")
            version = self.stage(kept.unionByName(new.select(old.columns)), by)
        self.swap(version)
        return version

    def replace_run(self, new: DataFrame, source_id: str, run_id: str, partition: str = "load_date") -> int:
        """Loads a run again without doubling it: its old rows go, the new ones come."""
        if self.current() is None:
            version = self.stage(new, (partition,))
        else:
            old = self.read()
            mine = (F.col("source_id") == source_id) & (F.col("dag_run_id") == run_id)
            kept = old.where(~F.coalesce(mine, F.lit(False)))
            version = self.stage(kept.unionByName(new.select(old.columns)), (partition,))
        self.swap(version)
        return version

    def append_window(self, new: DataFrame, at: str, cutoff) -> int:
        """Rows at or after a cutoff are loaded anew; rows without a time stay."""
        before = (F.col(at) < F.lit(cutoff)) | F.col(at).isNull()
        kept = self.read().where(before) if self.current() else new.limit(0)
        version = self.stage(kept.unionByName(new.where(F.col(at) >= F.lit(cutoff))))
        self.swap(version)
        return version


def upserted(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The rows of a keyed upsert, as a DataFrame."""
    return old.join(new.select(*key), key, "left_anti").unionByName(new.select(old.columns))


def coalesced(events: DataFrame, key: str = "source_id", at: str = "event_at", run: str = "dag_run_id") -> DataFrame:
    """Of a burst of events the newest run wins; the others are marked as merged away."""
    newest = events.groupBy(key).agg(F.max_by(run, F.struct(at, run)).alias("_newest"))
    status = F.when(F.col(run) == F.col("_newest"), F.col("status")).otherwise(F.lit("COALESCED"))
    return events.join(newest, key).withColumns({"status": status, "is_publishable": F.col("is_publishable") & (F.col(run) == F.col("_newest"))}).drop("_newest")


def dated_events(events: DataFrame, offset: int = 9) -> tuple[DataFrame, DataFrame]:
    """(good, refused): an event's load_date must be its local day."""
    own = F.date_format(F.col("event_at") + F.expr(f"INTERVAL {offset} HOURS"), "yyyy-MM-dd")
    good = F.coalesce(F.col("load_date") == own, F.lit(False))
    return events.where(good), events.where(~good)
