"""Incremental landing: the file-stream twin of the batch shredding job.

New files of (record_id, payload) rows are shredded as they arrive and appended, partitioned by table. The checkpoint
remembers which files are done, so a restarted run takes up where the last one stopped; a batch that is run again
replaces its own output, so no row is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vigilake.operators.shred import REPORT, Node, shred


def land(spark: SparkSession, source: str, target: str, checkpoint: str, root: Node = REPORT, files_per_batch: int = 1000) -> StreamingQuery:
    """Shreds every file in ``source`` that is new, then ends. Each batch goes to its own folder below ``target``."""
    stream = spark.readStream.schema("record_id bigint, payload string").option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def append(batch: DataFrame, number: int) -> None:
        shred(batch, root).write.mode("overwrite").partitionBy("table").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def landed(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target)
