"""Reading the given tables, and the folder that all executors share."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Callable, Iterator
from contextlib import suppress
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """``columns`` of one table; a column that the file lacks is an error."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, as the session or its context has it.

    A folder is made up only where none is set (tests, one machine).
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        folder = tempfile.mkdtemp(prefix="amity-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def shared_table(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again.

    Its lineage ends there, as with a checkpoint, but it is computed once, and its
    size is known to the planner, which then chooses joins by it. Shuffle files go as soon as
    it is written, and not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid4()}"
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    made = spark.read.schema(df.schema).parquet(path)
    vars(made)["shared_path"] = path
    return made


def drop_tables(*tables: DataFrame) -> None:
    """Deletes the files of tables from ``shared_table`` that nothing reads any more."""
    for made in tables:
        spark = made.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(vars(made)["shared_path"])
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which the memory it has freed goes back to the system: workers outlive their tasks, and
    would hold it beside what the JVM needs for a shuffle."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # glibc only
            ctypes.CDLL(None).malloc_trim(0)

    return whole


PACKED = "other columns"


def pack(docs: DataFrame, *plain: str) -> DataFrame:
    """The columns ``plain``, and all others within one struct, where their names clash with nothing."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in plain]
    # A struct needs a field; this one is longer than any column's name.
    filled = F.lit(0).alias("_" * (1 + max(map(len, docs.columns))))
    return docs.select(*plain, F.struct(*others, filled).alias(PACKED))


def unpack(packed: DataFrame, columns: list[str], *more: str) -> DataFrame:
    """``columns`` again, from the struct or beside it, then ``more``."""
    inside = packed.schema[PACKED].dataType.names

    def column(name: str) -> Column:
        return F.col(f"`{PACKED}`").getField(name).alias(name) if name in inside else F.col(f"`{name}`")

    return packed.select(*[column(c) for c in columns if c not in more], *more)
