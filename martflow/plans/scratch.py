"""Written scratch tables, in the folder the session names for checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"


def scratch_folder(spark: SparkSession) -> str:
    """A fresh path under ``spark.checkpoint.dir``, else under the session's warehouse.

    Both are folders that all executors share.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        root = f"{spark.conf.get(WAREHOUSE_SETTING).rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/martflow-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a frame once and go on from the files.

    Cuts the lineage, so a lost executor costs a re-read and not a recomputation.
    The schema is passed on, so a frame without rows reads back too.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(StructType(df.schema.fields)).parquet(path)
