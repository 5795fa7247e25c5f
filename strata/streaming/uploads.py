"""Configuration uploads as a stream.

The reference validates a dimension file per HTTP upload. The Spark form of
that route is a file-source stream over the folder the uploads land in: each
micro-batch holds the files that arrived since the last one, every file is
checked on its own (the upload path is part of the group key, so two uploads
of the same dimension never mix), and the report of the batch is written
under its own ``epoch=`` folder. Rewriting an epoch replaces it, so a batch
retried after a failure does not duplicate rows; the stream's checkpoint
location records which files were consumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators import peel as P
from strata.sources import config as C

UPLOAD = "upload"


def dimension_uploads(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of raw dimension configuration rows with their upload path."""
    reader = spark.readStream.schema(C.DIM_RAW).options(**C.CSV_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.csv(folder)
    return raw.select(F.col("_metadata.file_path").alias(UPLOAD), *raw.columns)


def upload_report(batch: DataFrame) -> DataFrame:
    """Validity of every (upload, dimension) of a batch of raw configuration rows."""
    cfg = C.parse_dimension_rows(batch, carry=(UPLOAD,))
    edges = C.config_edges(cfg, carry=(UPLOAD,))
    levels = C.declared_levels(cfg, carry=(UPLOAD,))
    keys = [UPLOAD, "dimension_id"]
    v = P.validity(edges, keys, groups=levels)
    return v.withColumn("answer", F.concat(F.lit("The dimension is "),
                                           F.when(F.col("valid"), "valid.").otherwise("not valid.")))


def start_upload_checks(spark: SparkSession, folder: str, out_path: str, checkpoint_location: str,
                        available_now: bool = True) -> StreamingQuery:
    """Start the stream: uploads in ``folder`` -> reports under ``out_path/epoch=N``."""

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        upload_report(batch).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch_id}")

    writer = (dimension_uploads(spark, folder).writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
