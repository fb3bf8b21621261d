"""Stage 1 over a folder that grows: each batch of new files is extracted once and appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.fixed import DEFAULT_TYPE
from ..plans import stages

SOURCE = "text string, title string, url string"


def extract_stream(spark: SparkSession, source: str, sink: str, checkpoint: str, wiki: bool = False, source_type: str = DEFAULT_TYPE, schema: str = SOURCE) -> StreamingQuery:
    """Reads the parquet files of ``source`` as they come; each micro-batch overwrites its own folder of the sink, so that a
    batch run again after a failure leaves no row twice. The plan has no state: late files are files like others."""
    def write(batch: DataFrame, number: int) -> None:
        stages.extract(batch, None, wiki, source_type).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    docs = spark.readStream.schema(schema).parquet(source).select(*[F.col(c.split()[0]) for c in schema.split(", ")])
    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
