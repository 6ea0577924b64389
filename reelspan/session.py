"""Session helpers: table access and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data folder (one file or a directory of parts)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where the cluster names none (local tests) a machine-local folder is set up.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="reelspan-")
        spark.sparkContext.setCheckpointDir(root)
        return spark.sparkContext.getCheckpointDir()
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder."""
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
