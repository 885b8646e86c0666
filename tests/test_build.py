import hashlib
import json

import pytest
import world
from pyspark.sql import functions as F

from placeforge.operators.tiers import guard_scan
from placeforge.plans import release
from placeforge.plans.build import build
from placeforge.sources import shapefile, writers


def regions(b):
    per = {r.admin1_id: r.n for r in b.settlements.groupBy("admin1_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {r.name: per.get(r.id, 0) for r in b.regions.collect()}


@pytest.mark.parametrize(("kind", "tier"), [({"coded": True}, 1), ({}, 4)])
def test_regions_of_the_small_world(spark, kind, tier):
    b = build(spark, world.scan(spark, **kind))
    assert regions(b) == {"District 1": 4, "District 2": 4}
    assert [r.tier for r in b.plan.collect()] == [tier]


def test_a_decoy_that_reaches_nothing_is_replaced(spark):
    b = build(spark, world.scan(spark, decoy=True))
    assert {k: v for k, v in regions(b).items() if v} == {"District 1": 4, "District 2": 4}
    assert [r.tier for r in b.plan.collect()] == [4]


def test_same_as(spark):
    b = build(spark, world.scan(spark, coded=True, duplicates=[(9200001, 9101010, None)]))
    assert sum(regions(b).values()) == 8
    b = build(spark, world.scan(spark, coded=True, duplicates=[(9200001, 9101010, 910101)]))
    assert sum(regions(b).values()) == 9


def test_the_parents_statement_places(spark):
    lost = 9101011
    b = build(spark, world.scan(spark, coded=True, drop_located=(lost,)))
    assert regions(b) == {"District 1": 3, "District 2": 4, "Testland": 1}
    b = build(spark, world.scan(spark, coded=True, drop_located=(lost,), contains=[(lost, 910001)]))
    assert regions(b) == {"District 1": 4, "District 2": 4}
    assert {r.id: r.admin1_source for r in b.settlements.collect()}[lost] == "stated"


def test_boundaries_place(spark):
    ring = [(False, [10.0, 10.0, 10.95, 10.95, 10.0], [49.5, 50.5, 50.5, 49.5, 49.5])]
    p = spark.createDataFrame([(0, "ZZ-01", 10.0, 49.5, 10.95, 50.5, ring)], shapefile.SCHEMA)
    lost = 9101011
    b = build(spark, world.scan(spark, coded=True, drop_located=(lost,), polygons=p))
    assert regions(b) == {"District 1": 4, "District 2": 4}
    assert {r.id: r.admin1_source for r in b.settlements.collect()}[lost] == "boundary"
    foreign = p.withColumn("code", F.lit("YY-01"))
    assert regions(build(spark, world.scan(spark, coded=True, drop_located=(lost,), polygons=foreign)))["Testland"] == 1


def test_learned_codes_place(spark):
    ring = [(False, [9.5, 9.5, 10.95, 10.95, 9.5], [49.5, 50.5, 50.5, 49.5, 49.5])]
    p = spark.createDataFrame([(0, "ZZ-OLD", 9.5, 49.5, 10.95, 50.5, ring)], shapefile.SCHEMA)
    more = [world.record(9300000 + k, country="Q900001", instance_of=["Q900004"], coord=f"Point(10.{k} 50.2)", labels={"en": f"More {k}"}, located_in=["Q910101"]) for k in range(4)]
    s = world.scan(spark, coded=True, drop_located=(9101011,), polygons=p, extra=more)
    s.located_in = s.located_in.union(spark.createDataFrame([(9300000 + k, 910101) for k in range(4)], "child long, parent long"))
    assert regions(build(spark, s)) == {"District 1": 8, "District 2": 4}


def files(out, manifest):
    return {p: (out / p).read_bytes() for e in manifest["countries"] for p in e["files"].values()}


def test_files_are_exact_and_repeatable(spark, tmp_path):
    s = world.scan(spark, coded=True, zones=spark.createDataFrame([("ZZ", "Test/Zone")], "iso2 string, zone string"))
    got = []
    for k, parts in enumerate(("3", "7")):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        out = tmp_path / str(k)
        out.mkdir()
        m = release.refresh(spark, s, str(out))
        got.append((m, files(out, m)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[0] == got[1]
    m, f = got[0]
    e = m["countries"][0]
    assert (e["regions"], e["settlements"], e["code"]) == (2, 8, "ZZ")
    for k, p in e["files"].items():
        assert e["sha256"][k] == hashlib.sha256(f[p]).hexdigest() and e["bytes"][k] == len(f[p])
    lines = [json.loads(x) for x in f["data/ZZ.ndjson"].decode().splitlines()]
    assert [x["type"] for x in lines] == ["country", "region", *["settlement"] * 4, "region", *["settlement"] * 4]
    assert lines[0]["name"] == "Testland" and lines[0]["capital_name"] == "District 1" and lines[0]["flag_emoji"] == "🇿🇿" and lines[0]["timezone_id"] == "Test/Zone"
    assert list(lines[2])[:11] == ["type", "id", "source", "admin1_id", "admin1_source", "country_code", "name", "name_lang", "slug", "latitude", "longitude"]
    nested = json.loads(f["json/ZZ.json"])
    flat = [s for r in nested["regions"] for s in r["settlements"]]
    assert [{k: v for k, v in x.items() if k != "type"} for x in lines if x["type"] == "settlement"] == flat
    rows = f["csv/ZZ.csv"].decode().split("\r\n")
    assert rows[0] == ",".join(writers.CSV_COLUMNS) and len(rows) == 10 and rows[-1] == ""
    assert m["s_version"] == writers.fingerprint(m["countries"])
    stats = json.loads((tmp_path / "0/build-stats.json").read_text())
    assert (stats["cities_total"], stats["countries_written"], stats["s_version"]) == (8, 1, m["s_version"])


def test_publish(spark, tmp_path):
    out, target = tmp_path / "out", tmp_path / "site"
    release.refresh(spark, world.scan(spark, coded=True), str(out))
    assert not target.exists() and release.publish(str(out), str(target), "v1", dry_run=True)["settlements"] == 8
    p = release.publish(str(out), str(target), "v1")
    assert json.loads((target / "latest.json").read_text()) == p and (target / "releases/v1/manifest.json").exists()
    with pytest.raises(ValueError, match="published"):
        release.publish(str(out), str(target), "v2")
    with pytest.raises(ValueError, match="exists"):
        (target / "latest.json").unlink()
        release.publish(str(out), str(target), "v1")
    release.publish(str(out), str(target), "v1", force=True)


def test_a_build_that_fails_its_gates_is_not_taken_over(spark, tmp_path):
    s, out = world.scan(spark, coded=True), tmp_path / "out"
    first = release.refresh(spark, s, str(out))
    before = files(out, first)
    with pytest.raises(ValueError, match="too few"):
        release.refresh(spark, s, str(out), check=lambda b, m, last: ["too few"] if last == first else [])
    assert files(out, first) == before and (tmp_path / "out-new/manifest.json").exists() and not (tmp_path / "out-prev").exists()
    seen = []
    release.refresh(spark, s, str(out), check=lambda b, m, last: seen.append(release.failed_gates(spark, b, m, last)) or [])
    assert files(out, first) == before and (tmp_path / "out-prev/manifest.json").exists() and not (tmp_path / "out-new").exists()
    assert not any("loss" in x or "ratio" in x for x in seen[0])


def test_trim(spark):
    other = [world.record(5, country="Q4", instance_of=["Q900004"], labels={"en": "Far"})]
    s = world.scan(spark, coded=True, extra=other)
    small = release.trim(s, spark.createDataFrame([(world.COUNTRY,)], "country_qid long"))
    ids = {r.id for r in small.entities.collect()}
    assert 5 not in ids and {world.COUNTRY, 910001, 9101010} <= ids
    assert regions(build(spark, small)) == {"District 1": 4, "District 2": 4}


def test_dirty_scan_stops(spark):
    s = world.scan(spark)
    with pytest.raises(ValueError, match="capital"):
        guard_scan(s.entities.withColumn("capital", F.lit(None).cast("array<string>")))
