"""Incremental calibration: statistics kept as moments and merged batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoweave.operators import calibrate as W


class IncrementalCalibration:
    """A table of statistics per micro-batch below ``path``; the union of all batches is their merge.

    Each batch writes its own folder, replacing it if the batch is repeated, so a replay after a failure
    counts nothing twice.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def process(self, features: DataFrame, batch_id: int) -> None:
        """Fold one batch of ``lang_style, feature, value`` rows in; usable as ``foreachBatch``."""
        part = features.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("lang_style", "feature").agg(
            F.count("value").alias("n"), F.avg("value").alias("mean"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std")
        )
        part.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def statistics(self) -> DataFrame:
        return W.merge(self.spark.read.parquet(self.path))

    def start(self, stream: DataFrame, checkpoint: str):
        """Run over a streaming ``lang_style, feature, value`` source until it has no more input."""
        writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        return writer.foreachBatch(lambda df, i: self.process(df, i)).start()
