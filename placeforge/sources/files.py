"""Readers of the smaller inputs: record shards, packed edges, time zones, allow-lists and manifests."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.schema import ENTITY


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Entity records from JSON lines in a folder or below it; fields that are missing are null."""
    return spark.read.schema(ENTITY).json(path, pathGlobFilter="{*.jsonl,*.jsonl.gz,part-*.json*}", recursiveFileLookup=True)


def write_records(records: DataFrame, path: str) -> None:
    """Records with their `shard` as JSON lines, a folder for each shard; fields that are null are left out."""
    records.repartition("shard").write.mode("overwrite").partitionBy("shard").json(path)


def read_packed_edges(spark: SparkSession, path: str) -> DataFrame:
    """child, parent from files of little-endian int32 pairs; a file cut inside a pair is an error."""

    def unpack(parts):
        for pdf in parts:
            for name, raw in zip(pdf["path"], pdf["content"], strict=True):
                if len(raw) % 8:
                    raise ValueError(f"{name} ends inside a pair")
                pairs = np.frombuffer(raw, dtype="<i4").reshape(-1, 2).astype("int64")
                yield pd.DataFrame({"child": pairs[:, 0], "parent": pairs[:, 1]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(unpack, "child long, parent long")


def write_packed_edges(df: DataFrame, path: str) -> None:
    """One file of int32 pairs, written batch by batch from the driver; for exchange, not for scale."""
    with open(path, "wb") as f:
        for row in df.select("child", "parent").toLocalIterator(prefetchPartitions=True):
            f.write(np.array([row.child, row.parent], dtype="<i4").tobytes())


def single_zones(spark: SparkSession, path: str) -> DataFrame:
    """iso2, zone of countries with exactly one zone in a tz table; nothing where the file is missing."""
    try:
        lines = spark.read.text(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], "iso2 string, zone string")
        raise
    return zones_of(lines)


def zones_of(lines: DataFrame) -> DataFrame:
    """single_zones over lines (value)."""
    cols = F.split("value", "\t")
    rows = lines.filter(~F.col("value").startswith("#") & (F.trim("value") != "") & (F.size(cols) >= 3))
    each = rows.select(F.explode(F.split(cols[0], ",")).alias("iso2"), F.trim(cols[2]).alias("zone"))
    g = each.groupBy(F.upper(F.trim("iso2")).alias("iso2")).agg(F.count_distinct("zone").alias("n"), F.min("zone").alias("zone"))
    return g.filter("n = 1").select("iso2", "zone")


def allow_list(lines: DataFrame) -> DataFrame:
    """code, reason from 'CODE: reason' lines (value)."""
    v = F.trim("value")
    code, reason = F.upper(F.trim(F.substring_index(v, ":", 1))), F.trim(F.regexp_extract(v, r"^[^:]*:(.*)$", 1))
    return lines.filter((v != "") & ~v.startswith("#")).select(code.alias("code"), F.when(reason == "", "(no reason given)").otherwise(reason).alias("reason"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """code, settlements, regions of a manifest in either of its shapes."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    doc = json.loads(text)
    rows = []
    for e in doc.get("countries") or doc.get("locations") or []:
        rows.append((e.get("code") or e.get("country_code"), int(e.get("settlements") or e.get("cities") or 0), int(e.get("regions") or 0)))
    return spark.createDataFrame(rows, "code string, settlements long, regions long")
