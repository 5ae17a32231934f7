"""Extraction over a stream of parquet files: stateless, so batches need nothing from each other; within a batch a
document's links are kept once. Delivery is exactly once by the sink's checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import fulltext
from ..sources.files import to_line


def stream_enrichments(spark: SparkSession, source: str, sink: str, checkpoint: str, now: str, **trigger) -> StreamingQuery:
    """Reads id, content files as they arrive and appends enrichment lines, one folder a batch (a batch that runs again
    replaces its own)."""
    docs = spark.readStream.schema("id string, content string").parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        from pyspark.sql import functions as F

        out = fulltext.enrichments(batch, now)
        out.select(to_line(F.struct(*out.columns)).alias("value")).write.mode("overwrite").text(f"{sink}/batch={number}")

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
