"""Session helpers: reading tables and cutting lineage in storage that every executor shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Where none is set, a local session takes a temporary one,
    removed at its end; any other is an error, as executors couldn't read what others wrote."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            named = tempfile.mkdtemp(prefix="vigilake-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there afterwards."""
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{_checkpoint_dir(spark)}/{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
