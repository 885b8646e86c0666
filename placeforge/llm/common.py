"""Shared plumbing of the training-data operators: column access, Arrow row maps, labelled samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from placeforge.tables import durable, release, shared_dir

__all__ = ["bounded_batches", "durable", "in_fold", "labelled", "map_columns", "release", "shared_dir", "table"]

#: Rows that a map turns into Python values at a time. Texts can be long, so they are few.
BATCH_ROWS = 256
#: Bytes after which an Arrow batch ends, and the most rows it has. They are the same for every plan, as a lazy plan
#: runs with what the session has when it is executed.
ARROW_BYTES, ARROW_ROWS = 16 << 20, 16_384


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table by Spark's own reader, so any store that Spark can read will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that reach Python."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def map_columns(
    df: DataFrame,
    columns: Sequence[str],
    schema: str | StructType,
    make: Callable[[], Callable[..., Sequence[list]]],
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """Apply a column-list function to slices of at most batch_rows rows.

    make() runs once in each task and returns a function that takes one Python list for each of
    `columns` and returns one list for each field of `schema`.
    """
    bounded_batches(df.sparkSession)
    struct = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            for at in range(0, b.num_rows, batch_rows):
                out = f(*(c.to_pylist() for c in b.slice(at, batch_rows).columns))
                yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(out, arrow, strict=True)], schema=arrow)

    return df.select(*[df[c] for c in columns]).mapInArrow(run, struct)


def in_fold(doc_id: str = "doc_id"):
    """True for held-out rows: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled(
    df: DataFrame, labels: DataFrame, columns: Sequence[str], fields: str, make: Callable[[], Callable[..., Sequence[list]]], most: int
) -> pa.Table:
    """What make() gives for at most about `most` labelled rows outside the held-out fold, with their label `y`.

    Ids are chosen by their hash, so the ids sent out and the rows that come back are bounded whatever the tables
    hold: an id counts once, with its least label and, of several rows, the one of least hash. Rows come in the
    order of that hash.
    """
    known = labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("__y"))
    known = known.filter(F.col("__y").isin(0, 1) & F.col("__id").isNotNull() & ~in_fold("__id"))
    known = known.groupBy("__id").agg(F.min("__y").alias("__y"))
    n = known.count()
    if n > most:
        known = known.filter(F.pmod(F.xxhash64("__id", F.lit(10)), F.lit(1 << 20)) < F.lit(int((1 << 20) * most / n)))
    rows = df.select("doc_id", *columns).join(F.broadcast(known), F.col("doc_id") == F.col("__id"))
    rows = rows.select("__id", "__y", F.xxhash64("__id", *[F.col(c) for c in columns]).alias("__h"), *columns)

    def outer():
        f = make()
        return lambda ids, ys, hashes, *values: (ids, ys, hashes, *f(*values))

    got = map_columns(rows, ("__id", "__y", "__h", *columns), f"id long, y int, h long, {fields}", outer)
    names = [c for c in got.columns if c != "id"]
    one = got.groupBy("id").agg(F.min_by(F.struct(*names), "h").alias("r")).select("r.*").toArrow()
    return one.sort_by([("h", "ascending"), ("y", "ascending")])
