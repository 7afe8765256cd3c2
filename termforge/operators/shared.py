"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A side of a join is broadcast only if its counted rows times its row bytes stay within this.
BROADCAST_BYTES = 16 << 20

_written: list[tuple] = []


def shared_dir(spark) -> str:
    """spark.checkpoint.dir. Where it is unset, a temporary folder in local runs, else one in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        alone = spark.sparkContext.master.split("[")[0] == "local"
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="termforge-") if alone else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/termforge-tmp")
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Written and read again: rounds do not grow the lineage, what several results use is computed once, and a lost executor repeats none of it."""
    folder = f"{shared_dir(df.sparkSession)}/termforge-{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/{name}")
    _written.append((df.sparkSession, folder))
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def release() -> None:
    """Delete the intermediate tables written so far; results that still read them must have been consumed."""
    while _written:
        spark, folder = _written.pop()
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session is gone; the folder is left to the cluster's own cleaning
            return


atexit.register(release)


def checked(small: DataFrame, row_bytes: int) -> DataFrame:
    """``small``, a written table, to be broadcast if its counted size is within BROADCAST_BYTES; else the join shuffles, and Spark splits hot keys."""
    return F.broadcast(small) if small.count() * row_bytes <= BROADCAST_BYTES else small
