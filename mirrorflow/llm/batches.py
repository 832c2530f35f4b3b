"""Size of the batches that pass between Spark and Python."""

from __future__ import annotations

from pyspark.sql import SparkSession

BATCH_BYTES = 16 << 20
BATCH_ROWS = 2000


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as rows, for texts of any length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
