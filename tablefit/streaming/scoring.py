"""Scoring and metric accumulation on Structured Streaming frames.

A fitted ``PipelineModel`` whose stages are row-wise (imputer surrogates,
assembler, scaler, encoders, a fitted classifier) transforms a streaming
frame exactly as a batch one, so new rows are scored as they arrive.  The
running confusion matrix is a streaming aggregation keyed by
(label, prediction): four keys of state whatever the volume, checkpointed in
the shared folder so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tablefit.operators.evaluate import confusion
from tablefit.session import scratch_path


def read_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream (schema is mandatory for streaming file sources)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def score_stream(model, stream: DataFrame) -> DataFrame:
    """Apply a fitted model / pipeline to a streaming frame."""
    return model.transform(stream)


def running_confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Streaming ``(label, prediction, count)``; emit with outputMode
    ``complete`` or ``update``."""
    return confusion(scored, label, prediction)


def start_confusion(scored: DataFrame, query_name: str, label: str = "label",
                    prediction: str = "prediction", checkpoint: str | None = None,
                    sink: str = "memory") -> StreamingQuery:
    """Start the running-confusion query; its checkpoint lives in the session's
    shared checkpoint folder unless a location is given."""
    spark = scored.sparkSession
    location = checkpoint or scratch_path(spark, f"stream-{query_name}")
    return (running_confusion(scored, label, prediction).writeStream
            .outputMode("complete").format(sink).queryName(query_name)
            .option("checkpointLocation", location).start())
