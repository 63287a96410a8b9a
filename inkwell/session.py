"""Sessions, tables and the cluster's shared folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "inkwell", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("INKWELL_DRIVER_MEMORY", "6g"))
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``; only where that is unset (tests) a temporary one is set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='inkwell-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder, so a lost executor loses nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager)
