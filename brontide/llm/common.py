"""What the operators share: tables, written intermediate results, column names, memory of workers."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_FOLDER: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which all machines share. Where it is unset, a temporary folder
    serves a local session, whose executors are the driver; a cluster is refused."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    if not _OWN_FOLDER:
        _OWN_FOLDER.append(tempfile.mkdtemp(prefix="brontide-"))
    return _OWN_FOLDER[0]


#: The folder of each application and shared folder for what only its session reads.
_SESSIONS: dict[tuple[str, str], str] = {}


def new_path(spark: SparkSession, what: str, stays: bool = False) -> str:
    """A path that nothing has had. Unless it stays it lies in a folder of the session, which is
    deleted when the session's JVM ends, whatever became of the operator that wrote there."""
    shared = shared_folder(spark)
    if stays:
        return f"{shared}/brontide/{what}-{uuid.uuid4().hex}"
    key = (spark.sparkContext.applicationId, shared)
    if key not in _SESSIONS:
        _SESSIONS[key] = f"{shared}/brontide/session-{uuid.uuid4().hex}"
        own = spark._jvm.org.apache.hadoop.fs.Path(_SESSIONS[key])
        fs = own.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(own)
        fs.deleteOnExit(own)
    return f"{_SESSIONS[key]}/{what}-{uuid.uuid4().hex}"


def deleted(spark: SparkSession, path: str) -> None:
    """Removes a folder that this library wrote."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)


@contextlib.contextmanager
def _batches(spark: SparkSession, arrow_rows: int | None, parquet_rows: int | None) -> Iterator[None]:
    """Rows of Arrow and Parquet batches for what runs inside; the session's own values come back."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": arrow_rows, "spark.sql.parquet.columnarReaderBatchSize": parquet_rows}
    old = {k: spark.conf.get(k) for k, v in wanted.items() if v}
    for k in old:
        spark.conf.set(k, str(wanted[k]))
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def written(df: DataFrame, what: str, arrow_rows: int | None = None, parquet_rows: int | None = None, path: str | None = None) -> DataFrame:
    """df, written as Parquet in the shared folder and read again: the lineage is cut there,
    and a lost executor costs no more than the tasks it ran. arrow_rows: rows that Python
    workers get at once, parquet_rows: rows that a scan holds at once, where rows are large."""
    spark = df.sparkSession
    path = path or new_path(spark, what)
    with _batches(spark, arrow_rows, parquet_rows):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Written results of one operator that are deleted when nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self._paths = spark, []

    def written(self, df: DataFrame, what: str, arrow_rows: int | None = None) -> DataFrame:
        path = new_path(self.spark, what)
        out = written(df, what, arrow_rows, path=path)
        self._paths.append((out, path))
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        for df, path in [x for x in self._paths if any(x[0] is f for f in frames)]:
            deleted(self.spark, path)
            self._paths = [x for x in self._paths if x[1] != path]

    def clear(self, *keep: DataFrame) -> None:
        self.drop(*(df for df, _ in self._paths if not any(df is k for k in keep)))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """A column name that df does not have for each of names, for working columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name.lower())
    return out


def text_of(col: str):
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def release(*memos: dict) -> None:
    """Empties what a Python worker remembers and gives its memory back, at the end of a task:
    idle workers of one stage would else keep it beside those of the next."""
    import ctypes
    import gc

    import pyarrow as pa

    for memo in memos:
        memo.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)
