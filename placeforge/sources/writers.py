"""Exact-byte files of a build: NDJSON, nested JSON, CSV, a manifest and statistics.

Lines are made one row at a time in Arrow batches, dealt by country and sorted inside a partition, and each
task streams its countries to files. Nothing but one line and one nested country at a time is held.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
import os
import shutil
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.constants import LICENSE, MANIFEST_SOURCE, SOURCE
from placeforge.operators.assemble import COUNTRY_KEYS, REGION_KEYS, SETTLEMENT_KEYS

CSV_COLUMNS = (
    "country_code", "country_name", "region_id", "region_name", "region_slug", "id", "name", "slug", "latitude",
    "longitude", "population", "place_type", "timezone_id", "source",
)
FORMATS = ("data", "json", "csv")


def compact(value: dict, sort_keys: bool = False) -> str:
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False, sort_keys=sort_keys)


def rows_by_country(countries: DataFrame, regions: DataFrame, settlements: DataFrame) -> DataFrame:
    """iso2, r_name, r_id, level, s_name, s_id, doc: every row as JSON text, with its place in the file."""

    def docs(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        return df.select(*[F.col(k) for k in ("iso2", "r_name", "r_id", "level", "s_name", "s_id")], row_json(df, keys).alias("doc"))

    none = F.lit("")
    c = countries.withColumns({"iso2": F.col("code"), "r_name": none, "r_id": F.lit(0), "level": F.lit(0), "s_name": none, "s_id": F.lit(0)})
    r = regions.withColumns({"iso2": F.col("country_code"), "r_name": F.col("name"), "r_id": F.col("id"), "level": F.lit(1), "s_name": none, "s_id": F.lit(0)})
    names = regions.select(F.col("id").alias("r_id"), F.col("country_code").alias("iso2"), F.col("name").alias("r_name"))
    s = settlements.withColumns({"iso2": F.col("country_code"), "r_id": F.col("admin1_id")}).join(names, ["r_id", "iso2"])
    s = s.withColumns({"level": F.lit(2), "s_name": F.col("name"), "s_id": F.col("id")})
    return docs(c, COUNTRY_KEYS).union(docs(r, REGION_KEYS)).union(docs(s, SETTLEMENT_KEYS))


def row_json(df: DataFrame, keys: tuple[str, ...]):
    """The columns of a row as compact JSON with the language's own number format, keys in the given order."""

    @F.pandas_udf("string")
    def one(rows: pd.DataFrame) -> pd.Series:
        cols = [plain(rows[k]) for k in keys]
        return pd.Series([compact(dict(zip(keys, v, strict=True))) for v in zip(*cols, strict=True)], dtype=object)

    types = dict(df.dtypes)
    safe = [F.to_json(F.col(k)).alias(k) if types[k].startswith(("map", "array")) else F.col(k).cast("string").alias(k) if types[k] in ("bigint", "int") else F.col(k) for k in keys]
    kinds = {k: "json" if types[k].startswith(("map", "array")) else "int" if types[k] in ("bigint", "int") else types[k] for k in keys}

    def plain(s: pd.Series) -> list:
        kind = kinds[s.name]
        if kind == "json":
            return [None if not isinstance(x, str) else ordered(json.loads(x)) for x in s]
        if kind == "int":
            return [None if not isinstance(x, str) else int(x) for x in s]
        return [None if x is None or x != x else x for x in s.astype(object)]

    return one(F.struct(*safe))


def ordered(value):
    """Maps with their keys in order: their order in Spark is not fixed."""
    return {k: value[k] for k in sorted(value)} if isinstance(value, dict) else value


def around(doc: dict, key: str) -> tuple[str, str]:
    """The compact text of doc with a list under `key`, keys in order: what stands before the list's items and after them."""
    parts = [(k, compact({k: doc[k]}, sort_keys=True)[1:-1]) for k in sorted(doc) if k != key]
    before = [text for k, text in parts if k < key] + [f"{json.dumps(key)}:["]
    after = ["]"] + [text for k, text in parts if k > key]
    return "{" + ",".join(before), ",".join(after) + "}"


class CountryFiles:
    """The three files of one country, fed row by row in file order and written as they come.

    Files have names of their own until they are closed, so a task that runs twice never writes into another's.
    """

    def __init__(self, out: str, code: str):
        self.code, self.out = code, out
        self.paths = {"data": f"data/{code}.ndjson", "json": f"json/{code}.json", "csv": f"csv/{code}.csv"}
        self.sha = {f: hashlib.sha256() for f in FORMATS}
        self.size = dict.fromkeys(FORMATS, 0)
        self.attempt = f".{uuid.uuid4().hex}"
        self.files = {f: open(os.path.join(out, p + self.attempt), "wb") for f, p in self.paths.items()}
        self.country: dict = {}
        self.region: dict = {}
        self.regions = self.settlements = self.in_region = 0
        self.country_end = self.region_end = ""
        self.write_csv(CSV_COLUMNS)

    def put(self, kind: str, raw: bytes) -> None:
        self.files[kind].write(raw)
        self.sha[kind].update(raw)
        self.size[kind] += len(raw)

    def write_csv(self, values) -> None:
        line = io.StringIO()
        csv.writer(line).writerow(["" if v is None else v for v in values])
        self.put("csv", line.getvalue().encode())

    def begin_country(self, doc: dict) -> None:
        self.country = doc
        begin, self.country_end = around(doc, "regions")
        self.put("json", begin.encode())

    def add(self, level: int, doc: dict) -> None:
        self.put("data", (compact({"type": ("country", "region", "settlement")[level], **doc}) + "\n").encode())
        if level == 0:
            self.begin_country(doc)
        elif level == 1:
            begin, end = around(doc, "settlements")
            self.put("json", (self.region_end + ("," if self.regions else "") + begin).encode())
            self.region, self.region_end, self.in_region = doc, end, 0
            self.regions += 1
        else:
            self.put("json", (("," if self.in_region else "") + compact(doc, sort_keys=True)).encode())
            self.in_region += 1
            self.settlements += 1
            c, r = self.country, self.region
            self.write_csv([c["code"], c["name"], r["id"], r["name"], r["slug"], *(doc[k] for k in CSV_COLUMNS[5:])])

    def close(self) -> dict:
        if not self.country_end:
            self.begin_country({})
        self.put("json", (self.region_end + self.country_end).encode())
        for f, file in self.files.items():
            file.close()
            os.replace(os.path.join(self.out, self.paths[f] + self.attempt), os.path.join(self.out, self.paths[f]))
        return {
            "code": self.code, "name": self.country.get("name"), "slug": self.country.get("slug"), "id": self.country.get("id"),
            "source": SOURCE, "regions": self.regions, "settlements": self.settlements, "files": self.paths,
            "sha256": {f: self.sha[f].hexdigest() for f in FORMATS}, "bytes": self.size,
        }


def write_build(spark: SparkSession, out: str, countries: DataFrame, regions: DataFrame, settlements: DataFrame, stats: dict | None = None) -> dict:
    """Write all files under `out`, a folder that executors share, and return the manifest.

    What comes back to the driver is one manifest entry for each country.
    """
    for f in FORMATS:
        shutil.rmtree(os.path.join(out, f), ignore_errors=True)
        os.makedirs(os.path.join(out, f), exist_ok=True)
    keys = ["iso2", "level0", "r_name", "r_id", "level", "s_name", "s_id"]
    rows = rows_by_country(countries, regions, settlements).withColumn("level0", F.when(F.col("level") == 0, 0).otherwise(1))
    dealt = rows.repartition("iso2").sortWithinPartitions(*keys).select("iso2", "level", "doc")

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: CountryFiles | None = None
        done = []
        for pdf in parts:
            for iso2, level, doc in zip(pdf["iso2"], pdf["level"], pdf["doc"], strict=True):
                if now is None or now.code != iso2:
                    if now:
                        done.append(compact(now.close()))
                    now = CountryFiles(out, iso2)
                now.add(int(level), json.loads(doc))
        if now:
            done.append(compact(now.close()))
        yield pd.DataFrame({"entry": pd.Series(done, dtype=object)})

    entries = [json.loads(r.entry) for r in dealt.mapInPandas(write, "entry string").collect()]
    manifest = make_manifest(entries)
    write_text(os.path.join(out, "manifest.json"), json.dumps(manifest, indent=2, sort_keys=True) + "\n")
    if stats is not None:
        stats = stats | {"s_version": manifest["s_version"], "countries_written": len(entries)}
        write_text(os.path.join(out, "build-stats.json"), json.dumps(stats, indent=4, sort_keys=True))
    return manifest


def write_text(path: str, text: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def fingerprint(entries: list[dict]) -> str:
    """Sixteen hex digits over 'file:hash' lines, countries in order, the three formats in turn."""
    lines = [f"{e['files'][f]}:{e['sha256'][f]}" for e in sorted(entries, key=lambda e: e["code"]) for f in FORMATS]
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def make_manifest(entries: list[dict]) -> dict:
    entries = sorted(entries, key=lambda e: e["code"])
    version = fingerprint(entries)
    return {"s_version": version, "version": version, "license": LICENSE, "source": MANIFEST_SOURCE, "countries": entries}


def fingerprint_column(lines: DataFrame, order: str, line: str) -> DataFrame:
    """The fingerprint as an aggregate over a small table of lines."""
    g = lines.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, line))), lambda x: x[line]), "\n").alias("all"))
    return g.select(F.substring(F.sha2("all", 256), 1, 16).alias("fingerprint"))
