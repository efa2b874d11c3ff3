"""Shared scratch storage: cutting lineage and sizing small tables.

``materialise`` writes a DataFrame as Parquet below the cluster's checkpoint folder and reads
it back.  That does three jobs at once: an iteration's lineage is cut in a way that survives a
lost executor, a shared sub-plan is computed once, and Catalyst knows the exact file size, so a
small table is broadcast only when it really is below ``spark.sql.autoBroadcastJoinThreshold``
and shuffled (with AQE skew splitting) otherwise.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# rows up to which a narrow lookup table is sent to every executor (some 100 MB)
LOOKUP_ROWS = 1_000_000
# bytes of a side that a join in a loop may broadcast
ROUND_BROADCAST = 256 << 10
BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
ADAPTIVE_BROADCAST = "spark.sql.adaptive.autoBroadcastJoinThreshold"
# setting under which Spark drops the shuffle files of an execution when it ends, not at some later garbage collection
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="tissueloom-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """This application's own folder inside the shared one."""
    return f"{shared_dir(spark)}/tissueloom-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, tag: str = "table") -> str:
    """A path in the scratch folder that nothing else uses."""
    return f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; call it once results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _bytes(text: str) -> int:
    """A size as Spark's settings write it: ``10485760``, ``10485760b``, ``10MB``, ``256k``, ``-1``."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-z]*)\s*", text.lower()).groups()
    return int(number) << {"k": 10, "m": 20, "g": 30, "t": 40, "p": 50}.get(unit[:1], 0)


@contextmanager
def small_broadcasts(spark: SparkSession, limit: int = ROUND_BROADCAST) -> Iterator[None]:
    """Inside, Catalyst broadcasts sides up to ``limit`` bytes only; a lower limit of the session stays.

    A broadcast passes the driver, and in a loop of hundreds of joins sides just below the usual limit add up to
    gigabytes there.  Holds for what is written or collected inside.
    """
    least = str(min(_bytes(spark.conf.get(BROADCAST)), limit))
    with _setting(spark, BROADCAST, least), _setting(spark, ADAPTIVE_BROADCAST, least):
        yield


@contextmanager
def record_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Inside, Python meets tables in batches of that many rows at most, for rows that are large."""
    with _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows)):
        yield


def materialise(df: DataFrame, tag: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and return a DataFrame that reads it back.

    The shuffle files of the write go when it ends, as nothing reads them again.
    """
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    with _setting(spark, CLEANUP, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*written: DataFrame) -> None:
    """Delete written tables that nothing reads any more; a loop calls it for what its next table replaces."""
    for table in written:
        spark = table.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lookup_table(df: DataFrame, tag: str = "lookup", max_rows: int = LOOKUP_ROWS) -> DataFrame:
    """Written narrow table, hinted for broadcast only after its rows have been counted.

    Meant for sides that meet a table exploded many times over, where falling just above the
    optimizer's file-size threshold would shuffle the exploded rows.  Beyond ``max_rows`` the
    plan is left to Catalyst.
    """
    table = materialise(df, tag)
    return F.broadcast(table) if table.count() <= max_rows else table
