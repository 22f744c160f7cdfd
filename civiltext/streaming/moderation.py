"""Analysing texts as they arrive.

Analysis looks at one text at a time and keeps no state, so a stream needs neither
watermark nor state store: the batch plan runs unchanged on every micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from civiltext.plans.analysis import analyze


def analyze_stream(texts: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The analysis columns on a streaming table."""
    if not texts.isStreaming:
        raise ValueError("not a streaming table; use analyze")
    return analyze(texts, text_col, **options)


def analyze_folder(spark: SparkSession, source: str, schema: StructType | str, target: str,
                   checkpoint: str, text_col: str = "text", files_per_batch: int = 1000,
                   **options) -> StreamingQuery:
    """Analyse the parquet files that are new in ``source``, append to ``target``, stop."""
    incoming = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
                .parquet(source))
    return (analyze_stream(incoming, text_col, **options).writeStream.format("parquet")
            .option("path", target).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())
