"""Incremental cleaning: new files are cleaned as they come, and texts seen before are left out.

The fingerprints seen are a table. Each micro-batch is cleaned by the same transformations as a whole corpus, anti-joined with the table and written under its batch
number, so that a batch that runs twice replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions import text as T
from ..operators.cleaning import annotate, clean_records
from ..runtime import Workspace
from ..sources.io import exists


def clean_stream(spark: SparkSession, source: str, schema: StructType | str, target: str, checkpoint: str, form: str = "parquet", title: str = "title", abstract: str = "abstract", category: str | None = "category", index: str = "idx", files: int | None = None) -> StreamingQuery:
    """Start an available-now query from `source` to `target` (clean records by batch) with its fingerprints in `target`_seen."""

    def batch(rows: DataFrame, number: int) -> None:
        work = Workspace(spark)
        clean = clean_records(annotate(rows, title, abstract, category, index, work=work)).withColumn("fp", T.fingerprint(F.col("abstract")))
        if exists(spark, f"{target}_seen"):
            seen = spark.read.parquet(f"{target}_seen").where(F.col("batch") != number)
            clean = clean.join(seen.select("fp").distinct(), "fp", "left_anti")
        kept = clean.withColumn("batch", F.lit(number)).persist()
        try:
            for df, path in ((kept.drop("fp"), target), (kept.select("fp", "batch"), f"{target}_seen")):
                df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
        finally:
            kept.unpersist()
            work.close()  # a stream may run for long: nothing of a batch stays

    reader = spark.readStream.format(form).schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.load(source).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
