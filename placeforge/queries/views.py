"""Place-shaped views of the star-schema tables: each query runs a library operator over one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def position(df: DataFrame) -> Column:
    """Where a row stands in a table as read: files by name, rows as they lie in them."""
    row = F.col("_metadata.row_index")
    return row if len(df.inputFiles()) == 1 else F.struct(F.col("_metadata.file_path").alias("file"), row.alias("row"))


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges nation -> region, customer -> nation, supplier -> nation, with ids apart."""
    n, c, s = (table(spark, sf_dir, t) for t in ("nation", "customer", "supplier"))
    up = n.select((F.col("n_nationkey") + 100).cast("long").alias("child"), F.col("n_regionkey").cast("long").alias("parent"))
    cust = c.select((F.col("c_custkey") + 1000).cast("long").alias("child"), (F.col("c_nationkey") + 100).cast("long").alias("parent"))
    supp = s.select((F.col("s_suppkey") + 10_000_000).cast("long").alias("child"), (F.col("s_nationkey") + 100).cast("long").alias("parent"))
    return up.union(cust).union(supp)


TREE_SQL = """
tree AS (
  SELECT CAST(n_nationkey + 100 AS BIGINT) AS child, CAST(n_regionkey AS BIGINT) AS parent FROM nation
  UNION ALL SELECT CAST(c_custkey + 1000 AS BIGINT), CAST(c_nationkey + 100 AS BIGINT) FROM customer
  UNION ALL SELECT CAST(s_suppkey + 10000000 AS BIGINT), CAST(s_nationkey + 100 AS BIGINT) FROM supplier)
"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, nation, lat, lng of customers."""
    c = table(spark, sf_dir, "customer")
    lat, lng = F.col("c_custkey") % 1700 / 10 - 85, (F.col("c_custkey") * 7) % 3500 / 10 - 175
    return c.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("long").alias("nation"), lat.alias("lat"), lng.alias("lng"))


POINTS_SQL = """
points AS (SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS nation, (c_custkey % 1700) / 10.0::DOUBLE - 85 AS lat,
  ((c_custkey * 7) % 3500) / 10.0::DOUBLE - 175 AS lng FROM customer)
"""


def class_ids(column: str):
    """A stable number for a class text: its CRC."""
    return F.crc32(F.col(column).cast("binary"))


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as settlements: id, region, name (from a short list, so that names collide), population."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("long").alias("admin1_id"),
        F.concat(F.lit("place "), (F.col("c_custkey") % 64).cast("string")).alias("name"),
        F.concat(F.lit("place-"), (F.col("c_custkey") % 64).cast("string")).alias("slug"),
        F.floor("c_acctbal").cast("long").alias("population"),
    )


ROWS_SQL = """
places AS (SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS admin1_id, 'place ' || (c_custkey % 64) AS name,
  'place-' || (c_custkey % 64) AS slug, CAST(floor(c_acctbal) AS BIGINT) AS population FROM customer)
"""
