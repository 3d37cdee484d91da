"""Partitioned Parquet tables that Spark's own writer keeps: merges that read and write only the
partitions they touch.

A table is a folder with a partition column of a fixed layout. A merge lays its new rows out first,
sees from them which partitions it touches, reads these by literals that reach the listing, and
writes them back by dynamic partition overwrite; no other file is read or written. Partitions
that lose their last row are removed. Dynamic overwrite replaces partitions when the job is
committed, one after another: a job that dies before that leaves the table as it was, and
every merge can be run again with the same rows. There is one writer at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """partition: the folder column; source: the column it comes from, whose day it is if of_day."""

    partition: str
    source: str
    of_day: bool = True

    def value(self) -> Column:
        return F.to_date(self.source) if self.of_day else F.col(self.source)

    @property
    def type(self) -> str:
        return "date" if self.of_day else "string"


#: The contract's layouts of collected rows, forecasts and observations.
COLLECTED = Layout("load_date", "load_date", of_day=False)
FORECAST = Layout("forecast_day", "forecast_at")
OBSERVED = Layout("observed_day", "observed_at")
#: Beyond so many touched partitions their least and greatest are told to the scan instead.
MOST_LITERALS = 2000
#: Tasks that share a partition's rows when it is written, and so the most files it gets.
FILES = 8


class PartitionedTable:
    """Rows in folders of one partition column. Of the day layouts that column is not part of the rows."""

    def __init__(self, spark: SparkSession, path: str, layout: Layout):
        self.spark, self.path, self.layout = spark, path.rstrip("/"), layout

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def current(self) -> bool:
        fs, p = self._fs(self.path)
        return fs.exists(p)

    def stored(self) -> DataFrame:
        """All rows with the partition column, in the layout's type whatever the folders look like."""
        rows = self.spark.read.parquet(self.path)
        return rows.withColumn(self.layout.partition, F.col(self.layout.partition).cast(self.layout.type))

    def read(self, start=None, end=None) -> DataFrame:
        """Rows whose partition lies from start to end, both included; other files are not listed."""
        rows, part = self.stored(), F.col(self.layout.partition)
        if start is not None:
            rows = rows.where(part >= self._literal(str(start)))
        if end is not None:
            rows = rows.where(part <= self._literal(str(end)))
        return rows.drop(self.layout.partition) if self.layout.of_day else rows

    def _literal(self, value: str) -> Column:
        return F.lit(value).cast(self.layout.type)

    def _values(self, rows: DataFrame) -> set[str | None]:
        """Partition values of rows: days, so they are few."""
        return {r[0] for r in rows.select(F.col(self.layout.partition).cast("string")).distinct().collect()}

    def _inside(self, values: set[str | None]) -> Column:
        known, part = sorted(v for v in values if v is not None), F.col(self.layout.partition)
        if len(known) > MOST_LITERALS:
            inside = part.between(self._literal(known[0]), self._literal(known[-1]))
        else:
            inside = part.isin(*map(self._literal, known)) if known else F.lit(False)
        return inside | part.isNull() if None in values else inside

    def _staged(self, new: DataFrame) -> tuple[DataFrame, str]:
        """New rows, written beside the table: they are computed once, whatever is asked of them."""
        path = f"{self.path}-new-{uuid.uuid4().hex}"
        new.withColumn(self.layout.partition, self.layout.value()).write.parquet(path)
        return self.spark.read.parquet(path), path

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _write(self, rows: DataFrame, mode: str) -> None:
        share = F.pmod(F.xxhash64(*rows.columns), F.lit(FILES))
        rows.repartition(self.layout.partition, share).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(self.layout.partition).parquet(self.path)

    def _replace(self, touched: set[str | None], rows: DataFrame, emptied: bool) -> None:
        """rows become all that the touched partitions hold. emptied: some of them may lose all rows."""
        gone = touched - self._values(rows) if emptied else set()
        self._write(rows, "overwrite")
        for value in gone:  # overwriting leaves a partition that gets no row as it was
            self.drop(value)

    def drop(self, value: str | None) -> None:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
        self._delete(f"{self.path}/{self.layout.partition}={name}")

    def append(self, new: DataFrame) -> None:
        self._write(new.withColumn(self.layout.partition, self.layout.value()), "append")

    def upsert(self, new: DataFrame, key: list[str], partition: str | None = None) -> set[str | None]:
        """Rows of new replace those of equal key; new must hold each key once. Where the layout's
        column is no part of the key, a key can move: its old partition is looked for in a scan
        of the key alone. Gives the partitions that were written."""
        staged, path = self._staged(new)
        try:
            if not staged.groupBy(*key).count().where("count > 1").isEmpty():
                raise ValueError(f"new rows repeat a key of {key}")
            touched = self._values(staged)
            if not self.current():
                self._write(staged, "append")
            elif touched:
                moves = self.layout.source not in key
                if moves:
                    touched |= self._values(self.stored().join(staged.select(*key), key, "left_semi"))
                old = self.stored().where(self._inside(touched))
                kept = old.join(staged.select(*key), key, "left_anti").select(old.columns)
                self._replace(touched, kept.unionByName(staged.select(old.columns)), moves)
        finally:
            self._delete(path)
        return touched

    def replace_run(self, new: DataFrame, source_id: str, run_id: str) -> set[str | None]:
        """Loads a run again without doubling it: its old rows go, the new ones come. Partitions
        that hold neither are not touched."""
        staged, path = self._staged(new)
        try:
            touched = self._values(staged)
            if not self.current():
                self._write(staged, "append")
                return touched
            mine = F.coalesce((F.col("source_id") == source_id) & (F.col("dag_run_id") == run_id), F.lit(False))
            touched |= self._values(self.stored().where(mine))
            if touched:
                old = self.stored().where(self._inside(touched) & ~mine)
                self._replace(touched, old.unionByName(staged.select(old.columns)), True)
        finally:
            self._delete(path)
        return touched

    def append_window(self, new: DataFrame, at: str, cutoff) -> set[str | None]:
        """Rows at or after a cutoff are loaded anew; older ones and those without a time stay."""
        since = F.col(at) >= F.lit(cutoff)
        staged, path = self._staged(new.where(since))
        try:
            touched = self._values(staged)
            if not self.current():
                self._write(staged, "append")
                return touched
            touched |= self._values(self.stored().where(since))
            if touched:
                old = self.stored().where(self._inside(touched) & ~F.coalesce(since, F.lit(False)))
                self._replace(touched, old.unionByName(staged.select(old.columns)), True)
        finally:
            self._delete(path)
        return touched

    def retain(self, first, keep: Column) -> set[str | None]:
        """Drops partitions before first without reading them; of the others only those with a
        row that keep refuses are written anew."""
        values = {v for v in self._values(self.stored()) if v is not None}
        old = {v for v in values if v < str(first)}
        for value in old:
            self.drop(value)
        if values == old:
            return old
        refused = ~F.coalesce(keep, F.lit(False))
        touched = self._values(self.stored().where(refused))
        if touched:
            self._replace(touched, self.stored().where(self._inside(touched) & ~refused), True)
        return old | touched
