"""Intermediate tables in the cluster's shared checkpoint folder.

A stage that several later jobs read is written once as Parquet. That cuts the lineage in a way
that survives the loss of executors, keeps column pruning for the readers, and gives Catalyst the
true size of the table, so that a small one is broadcast and a large one is not, without hints.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(builder: SparkSession.Builder) -> SparkSession:
    """The session of ``builder`` for work on one machine, such as tests and benchmarks.

    Where ``spark.checkpoint.dir`` is unset it becomes a temporary folder. The setting is fixed when
    a session starts, so one that lacks it is started again.
    """
    spark = builder.getOrCreate()
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.stop()
        folder = tempfile.mkdtemp(prefix="mirrorflow-")
        spark = builder.config("spark.checkpoint.dir", folder).getOrCreate()
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; if unset, one in the session's warehouse.

    Both are shared by the driver and all executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch").rstrip("/")


def _own_root(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/mirrorflow-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for ``name`` that no other call returns."""
    return f"{_own_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and return a reader of the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all tables that this application has written to the scratch folder.

    For the end of an application: results that have not been written elsewhere are lost.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
