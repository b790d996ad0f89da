"""Documents as they arrive: the row-wise stages over a stream of JSON lines.

The cleaning stages that compare documents need all of them and stay batch stages; what is here works on one row at a
time, so a stream and a batch give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from grainmill.operators.dedup import document_key
from grainmill.operators.filters import min_length
from grainmill.sources.readers import CORPUS


def read_jsonl_stream(spark: SparkSession, folder: str, schema: str = CORPUS, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def keyed(docs: DataFrame, least: int = 200) -> DataFrame:
    """Documents that are long enough, with the digest under which the batch stage compares them."""
    return min_length(docs, least).withColumn("sha", document_key())


def land(docs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends Parquet exactly once and ends when all files at hand are read."""
    return docs.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
