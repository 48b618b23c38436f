"""Intermediate tables written to the shared checkpoint folder.

Loops and two-pass operators need a frame whose lineage is cut and whose rows are
fixed.  Both come from a Parquet table in the folder named by ``spark.checkpoint.dir``:
it outlives any executor, and unlike a serialized checkpoint it is columnar, so later
reads prune columns and Catalyst sees its size when it picks a join.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="wordloom-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/wordloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a scratch table and return the table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def release(table: DataFrame) -> None:
    """Delete a table of ``materialize`` that nothing will read again; other frames are left alone."""
    path = getattr(table, "scratch_path", None)
    if path is not None:
        spark = table.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
