"""Score new listings as they arrive (M5 over a file stream).

Files appearing under ``source`` are read incrementally with a declared
schema, scored by a fitted ``PipelineModel`` (per micro-batch, inside the
executors - the model's trees are broadcast by MLlib), and appended to a
Parquet sink. The checkpoint location records which files were consumed
and which batches were committed, so a restarted query (or one that lost
executors) neither skips nor duplicates output.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roomrate.operators.regress import predict


def score_stream(spark: SparkSession, model: PipelineModel, source: str, schema: T.StructType,
                 sink: str, checkpoint: str, keep: list[str], file_glob: str | None = None,
                 available_now: bool = True, max_files_per_trigger: int | None = None,
                 recursive: bool = False) -> StreamingQuery:
    """``recursive``: also pick up files in sub-folders of ``source`` (one
    folder per landed batch, for instance)."""
    reader = spark.readStream.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    scored = predict(model, reader.parquet(source), keep=keep)
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", sink).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
