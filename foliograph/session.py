"""Session helpers: the shared scratch folder and the settings we rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans are written for.  Partition counts are left to adaptive
# execution; a cluster sets spark.sql.shuffle.partitions to a small multiple
# of its cores.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a
    cluster without it is an error, since a machine-local folder would be lost
    with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="foliograph-")
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed now and kept in the shared folder, its lineage cut."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder for one intermediate table."""
    return f"{checkpoint_root(spark)}/foliograph/{label}-{uuid.uuid4().hex}"
