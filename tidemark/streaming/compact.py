"""Compaction of small landed files into few large ones, as a file stream.

A landing per payload leaves a file per payload, which no reader at scale can
list or open quickly. The stream takes each file once, remembers it in its
checkpoint and writes what it holds as JSON lines of the table layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources import landing

_FOLDERS = ["dataset", "ingest_ts", landing.BATCH]


def compact(
    spark: SparkSession, landed: str, table: str, checkpoint: str, *, layout: str = "files"
) -> StreamingQuery:
    """Write the payloads of all files not seen before to ``table``, then stop.

    ``table`` is read with ``layout="table"``; nothing but this stream may write
    to it. Each micro-batch has its own folder under every stamp and replaces it
    when repeated, so after a lost run no payload is missing or doubled. Small
    stamps share a task and large ones are split, so the files, which are
    compressed whole, are bounded. Payloads that cannot be read keep their text
    and the name of their file. The landed files stay; those the checkpoint has
    finished with may be removed.
    """
    if layout not in ("files", "table"):
        raise ValueError("layout must be 'files' or 'table'")

    def stored(payloads: DataFrame, dataset: str) -> DataFrame:
        renamed = payloads.withColumnsRenamed({"file": landing.ORIGIN, landing.CORRUPT: landing.BROKEN})
        return renamed.withColumn("dataset", F.lit(dataset))

    snapshots = stored(landing.stream_snapshots(spark, landed, layout), landing.SNAPSHOT_DATASET)
    histories = stored(landing.stream_histories(spark, landed, layout), landing.HISTORY_DATASET)
    both = snapshots.unionByName(histories, allowMissingColumns=True)

    def write(payloads: DataFrame, epoch: int) -> None:
        stream = spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first().id
        (
            payloads.withColumn(landing.BATCH, F.lit(f"{stream}-{epoch}"))
            .hint("rebalance", *_FOLDERS)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "gzip")
            .partitionBy(*_FOLDERS)
            .json(table)
        )

    return (
        both.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
