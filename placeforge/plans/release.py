"""Publishing a build to a folder, comparing two builds, cutting a small scan, and the chain of stages."""

from __future__ import annotations

import datetime
import json
import os
import shutil
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.operators.gates import run_gates
from placeforge.operators.graph import reach_up
from placeforge.plans.build import Build, Scan, build, stats
from placeforge.sources.writers import FORMATS, fingerprint, write_build, write_text


def manifest_rows(spark: SparkSession, manifest: dict) -> DataFrame:
    """code, settlements, regions, sha of a manifest."""
    rows = [(e["code"], int(e["settlements"]), int(e["regions"]), ",".join(e["sha256"][f] for f in FORMATS)) for e in manifest["countries"]]
    return spark.createDataFrame(rows, "code string, settlements long, regions long, sha string")


def publish(out: str, target: str, version: str | None = None, force: bool = False, dry_run: bool = False) -> dict:
    """Copy a build to <target>/releases/<version> and point <target>/latest.json at it, last of all.

    A build that is published already or a version that exists is refused unless forced; so is a manifest whose
    fingerprint does not fit its files.
    """
    with open(os.path.join(out, "manifest.json"), encoding="utf-8") as f:
        manifest = json.load(f)
    if fingerprint(manifest["countries"]) != manifest["s_version"]:
        raise ValueError("the manifest's fingerprint does not fit its entries")
    pointer = os.path.join(target, "latest.json")
    if os.path.exists(pointer) and not force:
        with open(pointer, encoding="utf-8") as f:
            if json.load(f).get("s_version") == manifest["s_version"]:
                raise ValueError(f"{manifest['s_version']} is published already")
    now = datetime.datetime.now(datetime.UTC)
    version = version or now.strftime("%Y.%m.%d")
    folder = os.path.join(target, "releases", version)
    if os.path.exists(folder) and not force:
        raise ValueError(f"{folder} exists")
    entries = manifest["countries"]
    latest = {
        "version": version, "s_version": manifest["s_version"], "license": manifest["license"], "source": manifest["source"],
        "countries": len(entries), "settlements": sum(e["settlements"] for e in entries), "regions": sum(e["regions"] for e in entries),
        "bytes": sum(sum(e["bytes"].values()) for e in entries), "manifest": f"releases/{version}/manifest.json",
        "released": now.strftime("%Y-%m-%dT%H:%M:%SZ"),
    }
    if not dry_run:
        shutil.copytree(out, folder, dirs_exist_ok=force)
        write_text(pointer + ".new", json.dumps(latest, indent=1) + "\n")
        os.replace(pointer + ".new", pointer)
    return latest


def trim(scan: Scan, countries: DataFrame) -> Scan:
    """A scan of chosen countries (country_qid): their records, all ancestors, what the countries refer to, and
    their direct children; edges stay where the child stays."""
    home = F.regexp_extract("country", "^Q([0-9]+)$", 1).try_cast("bigint")
    c = countries.select(F.col("country_qid").alias("id"))
    own = scan.entities.select("id", home.alias("h")).join(c.select(F.col("id").alias("h")), "h", "left_semi").select("id").union(c).distinct()
    up = reach_up(scan.located_in, own.select(F.col("id").alias("qid"))).select(F.col("qid").alias("id"))
    refs = scan.entities.join(c, "id", "left_semi").select(F.explode(F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in ("capital", "currency", "continent", "official_language")])).alias("r"))
    refs = refs.select(F.regexp_extract("r", "^Q([0-9]+)$", 1).try_cast("bigint").alias("id")).filter("id is not null")
    kids = scan.located_in.join(c.select(F.col("id").alias("parent")), "parent", "left_semi").select(F.col("child").alias("id"))
    keep = own.union(up).union(refs).union(kids).distinct().persist()
    by_child = lambda e: e.join(keep.select(F.col("id").alias("child")), "child", "left_semi").select("child", "parent")
    return Scan(scan.entities.join(keep, "id", "left_semi"), scan.subclass, by_child(scan.located_in), by_child(scan.contains), scan.polygons, scan.zones)


def failed_gates(spark: SparkSession, b: Build, manifest: dict, baseline: dict | None = None) -> list[str]:
    """The gates that a build fails, against a baseline's manifest where there is one; none means it may be published."""
    old = manifest_rows(spark, baseline) if baseline else None
    found = run_gates(b.countries, b.settlements, manifest_rows(spark, manifest), old)
    return [f"{r.gate}: {r.value}" for r in found.filter("not ok").orderBy("gate").collect()]


def refresh(spark: SparkSession, scan: Scan, out: str, wanted: tuple[str, ...] | None = None, check=None) -> dict:
    """Build beside `out`, check, and only then take its place; the last build stays as `<out>-prev`.

    check(build, manifest, last manifest or None) gives the reasons against the build, as `failed_gates` does. With any, or when
    the build fails, `out` is left as it was and what was built stays in `<out>-new`.
    """
    fresh, held = f"{out}-new", os.path.join(out, "manifest.json")
    shutil.rmtree(fresh, ignore_errors=True)
    os.makedirs(fresh)
    last = None
    if os.path.exists(held):
        with open(held, encoding="utf-8") as f:
            last = json.load(f)
    began = time.monotonic()
    b = build(spark, scan, wanted)
    manifest = write_build(spark, fresh, b.countries, b.regions, b.settlements, stats(b, time.monotonic() - began))
    against = check(b, manifest, last) if check else []
    if against:
        raise ValueError("the build is not taken over: " + "; ".join(against))
    if last is not None:
        shutil.rmtree(f"{out}-prev", ignore_errors=True)
        os.rename(out, f"{out}-prev")
    elif os.path.isdir(out):
        shutil.rmtree(out)
    os.rename(fresh, out)
    return manifest
