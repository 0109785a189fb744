"""Session helpers shared by every query: tables, checkpoints, partition sizing."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory (a parquet file or a folder of them)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for reliable checkpoints.

    A cluster names a shared folder in ``spark.checkpoint.dir``; one that does
    not is an error, since no folder of one machine would do.  Only a local
    session without the setting (tests) gets a folder of this machine.
    """
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    folder = context.getConf().get("spark.checkpoint.dir", "")
    if not folder and not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not folder:
        folder = tempfile.mkdtemp(prefix="sonoweave-ckpt-")
    context.setCheckpointDir(folder)
    return folder


def reliable(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, so that later readers do not
    recompute it and the loss of an executor costs nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

