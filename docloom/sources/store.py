"""Intermediate tables in the folder that driver and executors share: they cut lineage and outlive executors.

All tables of a session lie in one folder below it. Whoever knows that nothing reads a table any more drops it with
drop_stored(); clean() removes the rest, once the session's results are written.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's switch for removing an execution's shuffle files at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Where it is unset, a local session gets a temporary folder (tests); a cluster without one is an error.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="docloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def session_dir(spark: SparkSession) -> str:
    """This session's own folder below the shared one."""
    return f"{shared_dir(spark)}/docloom-{spark.sparkContext.applicationId}"


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Executions begun in here remove their shuffle files at their end, not when the driver happens to collect its garbage.

    For those alone whose results are written: nothing reads their shuffles again.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """The frame, written as Parquet in the shared folder and read again; and the table's path."""
    path = f"{session_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    with swept(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_stored(spark: SparkSession, *paths: str) -> None:
    """Delete tables that stored() wrote and nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clean(spark: SparkSession) -> None:
    """Delete every table that this session has stored; frames that still read one fail from here on."""
    drop_stored(spark, session_dir(spark))
