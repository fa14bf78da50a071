"""Session settings the caller applies, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the operators are written for. ANSI mode stays at Spark 4's default (on).
# The two Arrow limits bound the memory of one Python batch, since one HTML page can
# be megabytes long.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def apply_session_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime-settable values above on a session the caller owns."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def object_store_conf(
    endpoint: str, access_key: str, secret_key: str, secure: bool = False
) -> dict[str, str]:
    """Settings for ``s3a://`` paths on an S3-compatible store; pass them to the builder."""
    scheme = "https" if secure else "http"
    return {
        "spark.hadoop.fs.s3a.endpoint": f"{scheme}://{endpoint}",
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.aws.credentials.provider":
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
    }


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session without that setting gets a folder of this machine: on a
    cluster such a folder would not be seen by the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written_table(table: DataFrame, label: str) -> DataFrame:
    """The same rows, read back from a table in the shared scratch folder.

    For intermediate results that are read several times or feed an expensive step: they
    survive the loss of an executor, and Spark knows their real size.
    """
    path = scratch_path(table.sparkSession, label)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
