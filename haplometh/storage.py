"""Cutting lineage between jobs with tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: Codec of tables of sites: a third smaller than Parquet's usual one.
SITE_CODEC = "zstd"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where a local session names none (tests, one machine), the context's own
    checkpoint folder, set to a temporary one the first time. A cluster's
    executors do not share such a folder, so there the setting must be given.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call returns."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, by: Sequence[str] = (), compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder, partitioned ``by`` columns, and read it back.

    A result that several later jobs need is computed once, survives the loss
    of executors, and its scan reports its real size, so Spark's own
    size-checked choice between broadcast and shuffle is an informed one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*by).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
