"""Helpers the operators of this subpackage share: table access and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read by Spark so that any store Spark reads will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    """A column's name as an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def packed_row(names: Sequence[str]) -> Column:
    """The named columns as one column ``row``, so that none of their names can clash with those an operator adds."""
    return F.struct(*(F.col(quoted(c)) for c in names)).alias("row")


def unpacked_row(names: Sequence[str]) -> list[Column]:
    """The columns of ``row`` again."""
    return [F.col(f"row.{quoted(c)}").alias(c) for c in names]


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where that is unset, a local session (as in tests) gets a new folder; any other
    is an error, since executors would not see each other's files."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="colonnade-"))
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder: later reads survive a lost executor and cut the lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, clean: bool = True) -> DataFrame:
    """``df`` written as a table in the shared folder and read again; more compact than ``durable`` for large tables, and of a size that Spark knows: what it
    thinks of the sizes of joins would multiply from round to round.

    The step's shuffle files are of no use once its table is there, so the cleaner is told to look for them. The table goes
    when the program ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    if clean:
        release(spark)
    return out


def release(spark: SparkSession) -> None:
    """Lets the context's cleaner remove the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is not None and context._jvm is not None:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def trim() -> None:
    """Gives memory that a worker no longer uses back to the system: a worker serves stage after stage, and what one of them freed would stay with it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def skew_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """left join right on ``key``, where left may hold very many rows of one key and right few.

    An input that an aggregation has already dealt by the key would be joined as it lies, and adaptive execution could not
    split its large partitions. A second key that follows from the first makes Spark deal both sides for this join.
    """
    a, b = left.withColumn("_dealt", F.hash(key)), right.withColumn("_dealt", F.hash(key))
    return a.join(b, [key, "_dealt"], how).drop("_dealt")
