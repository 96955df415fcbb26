"""What the operators of this subpackage share: the shared folder, cut lineage, normalisation."""

from __future__ import annotations

import contextlib
import contextvars
import string
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder that the driver and all executors see.

    It is `spark.checkpoint.dir` of the session. Only a local master (threads of one process) may
    run without that setting; it then gets a temporary folder, set as the checkpoint folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="boxloom-"))
        root = sc.getCheckpointDir()
    if root.startswith("file:") and not root.startswith("file://"):
        root = "file://" + root.removeprefix("file:")
    return root if "://" in root else f"file://{root}"


#: Paths to delete at the end of the innermost `passing` of this thread (or task of an event loop).
_PASSING: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("passing", default=None)


def scratch(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new path in the shared folder; within `passing` it goes with the rest, unless it is to be kept."""
    path = f"{shared_dir(spark)}/boxloom/{name}-{uuid.uuid4().hex}"
    mine = _PASSING.get()
    if mine is not None and not keep:
        mine.append(path)
    return path


@contextlib.contextmanager
def passing(spark: SparkSession):
    """Within it, what is written to the shared folder is deleted at the end, but for what is kept.

    For intermediate tables of a result that has itself been written: nothing reads them any more.
    """
    mine: list[str] = []
    outer = _PASSING.set(mine)
    try:
        yield
    finally:
        _PASSING.reset(outer)
        for path in mine:
            spark.sql(f"DROP TABLE IF EXISTS {table_name(path)}")
            remove(spark, path)


def table_name(path: str) -> str:
    return f"boxloom_{path.rpartition('-')[2]}"


@contextlib.contextmanager
def configured(spark: SparkSession, key: str, value: str):
    """Within it, the session's setting `key` has another value; plans made outside are not touched."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def shuffles_dropped(spark: SparkSession):
    """Within it, a query's shuffle files go as soon as the query has ended, not when the driver collects garbage."""
    return configured(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def materialise(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write `df` to the shared folder and read it again: the lineage ends at files that outlive executors."""
    path = scratch(df.sparkSession, name, keep)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The largest table, in rows, that is broadcast.
SMALL = 100_000


def joinable(df: DataFrame, name: str) -> DataFrame:
    """`df`, written, to be broadcast if it has at most `SMALL` rows; else it is joined by shuffle."""
    written = materialise(df, name)
    return F.broadcast(written) if written.count() <= SMALL else written


#: Rows of a block: the low bits of a row number count within it.
BLOCK_BITS = 12
#: Bytes of text after which the next row begins a new block.
BLOCK_BYTES = 16 << 20


class RowNumbers:
    """Numbers for the rows of this task, in order: unique over all tasks, the same if the task is run again.

    The bits above `BLOCK_BITS` are the row's block, which ends after 4096 rows or `BLOCK_BYTES` bytes,
    so that the texts of a block can be held at once (a longer text is a block of its own).
    """

    def __init__(self):
        from pyspark import TaskContext

        self.block, self.rows, self.bytes = TaskContext.get().partitionId() << (36 - BLOCK_BITS), 0, 0

    def take(self, size: int) -> int:
        """The number of a row whose text has `size` bytes."""
        if self.rows == 1 << BLOCK_BITS or (self.rows and self.bytes + size > BLOCK_BYTES):
            self.block, self.rows, self.bytes = self.block + 1, 0, 0
        number = self.block << BLOCK_BITS | self.rows
        self.rows, self.bytes = self.rows + 1, self.bytes + size
        return number


def in_blocks(df: DataFrame, name: str) -> DataFrame:
    """Write `df`, whose `row` is from `RowNumbers`, as a table bucketed by `block`, without a shuffle.

    A block are the rows that one task read one after another, as far as `RowNumbers` lets it grow. As the table is bucketed, it
    can be grouped with other data of its blocks while only these are shuffled.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    table = table_name(path)
    keyed = df.withColumn("block", F.shiftright("row", BLOCK_BITS))
    with shuffles_dropped(spark):
        keyed.write.format("parquet").bucketBy(partitions(spark), "block").option("path", path).option("compression", "zstd").saveAsTable(table)
    return spark.table(table)


def store(spark: SparkSession, path: str):
    """(file system, path) of a URI, through Hadoop, so any store works."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    files, target = store(spark, path)
    files.delete(target, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    files, target = store(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(target)) if files.exists(target) else []


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, whose name is all it says: there at once or not at all."""
    files, target = store(spark, path)
    files.create(target, False).close()


def fresh(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it (Spark's names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null stays null."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per context, so that Python workers can import it anywhere."""
    sc = spark.sparkContext
    if getattr(sc, "_boxloom_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="boxloom-ship-")) / "boxloom_package.zip"
    with zipfile.ZipFile(target, "w") as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, Path(package.name) / source.relative_to(package))
    sc.addPyFile(str(target))
    sc._boxloom_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
