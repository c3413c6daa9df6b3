"""Where operators of this package cut lineage, and small expressions that several of them use."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters, as a Java pattern and as text for trimming.
SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\f\r"
ARROW_ROWS, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new one in local mode only."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="glyphflow-"))
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Rows go to Python in batches of so many: with texts or sets in them, Spark's default is hundreds of MB for each task."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: later plans start from files, not from lineage."""
    path = new_folder(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[id(out)] = weakref.ref(out), path
    return out


def found(spark: SparkSession, path: str, names: list[str], schema: str) -> DataFrame:
    """The rows of files below path that tasks wrote by themselves. names: what the tasks that count returned; files of
    those that failed are in the folder too."""
    out = spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)
    _folders[id(out)] = weakref.ref(out), path
    return out


_folders: dict[int, tuple[weakref.ref, str]] = {}


def discard(*frames: DataFrame) -> None:
    """Deletes the files of written() and found() frames that nothing will read any more: what was made of them is written itself."""
    for df in frames:
        kept, path = _folders.pop(id(df), (None, ""))
        if kept is not None and kept() is df:
            spark = df.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: What Python workers remember from task to task, to be dropped by whoever needs the room.
_remembered: list[Callable[[], None]] = []


def remembers(clear: Callable[[], None]) -> None:
    _remembered.append(clear)


def forget() -> None:
    """Drops what tokenizers have remembered in this worker, which may have run another operator before."""
    for clear in _remembered:
        clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once for each row even where body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def ascii_words(text: Column) -> Column:
    """The words between ASCII white space as an array; empty for null or blank text."""
    return let(
        F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE + "+")),
    )


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Join condition in which nulls match."""
    out = left[names[0]].eqNullSafe(right[names[0]])
    for n in names[1:]:
        out = out & left[n].eqNullSafe(right[n])
    return out
