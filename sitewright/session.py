"""Session defaults and lineage cuts."""
from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a batch of 10,000 long texts would fill a Python worker
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    return spark


def stage_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a scratch folder only for a local session without one."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    key = spark.sparkContext.applicationId
    if key not in _LOCAL:
        _LOCAL[key] = tempfile.mkdtemp(prefix="sitewright-")
    return _LOCAL[key]


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage: write the frame once as a Parquet table in the shared folder and go on from there.

    Unlike a checkpointed RDD the plan runs once, and a lost executor costs a file read, not a recomputation.
    """
    path = f"{stage_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
