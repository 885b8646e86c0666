"""The dump scan as a stream: new dump files become statements, from which records are made when they are asked for.

The batch scan needs every statement of a subject at once. The stream keeps the parsed statements as an
append-only table; `records` groups all of it, or only the subjects that the given batches touched, and its results equal
those of the batch scan over all files seen so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from placeforge.sources.triples import group_subjects, kept_statements, parse_lines


def statements_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Parsed statements of new text files in a folder; positions order lines inside one micro-batch."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return lines.select(F.col("value").alias("line"))


def start(spark: SparkSession, folder: str, out: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Append statements under <out>/statements with the batch number before each position."""

    def one(batch: DataFrame, number: int) -> None:
        pos = F.lit(number << 48) + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 48))
        parsed = kept_statements(parse_lines(batch.withColumn("pos", pos)))
        # A batch that runs again overwrites its own folder: each is written once, whatever fails.
        parsed.write.mode("overwrite").parquet(f"{out}/statements/batch={number}")

    writer = statements_stream(spark, folder, files_per_batch).writeStream.foreachBatch(one)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def records(spark: SparkSession, out: str, batches: list[int] | None = None) -> DataFrame:
    """The records of all statements so far; with batch numbers, of the subjects that those batches touched."""
    every = spark.read.parquet(f"{out}/statements")
    if batches is not None:
        every = every.join(every.filter(F.col("batch").isin(batches)).select("subject").distinct(), "subject", "left_semi")
    return group_subjects(every.drop("batch"))
