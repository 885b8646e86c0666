"""The whole build: records and edges in, flat country, region and settlement tables out.

One lazily built lineage, cut at the graph loops and where a stage is used more than once. Two small results
reach the driver: which countries still lack divisions, and how well each country's settlements attached.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.functions.columns import parse_point
from placeforge.operators import assemble, classify, collisions, graph, placement, spatial, tiers
from placeforge.tables import durable


@dataclass
class Scan:
    """What a build starts from."""

    entities: DataFrame
    subclass: DataFrame
    located_in: DataFrame
    contains: DataFrame
    polygons: DataFrame | None = None
    zones: DataFrame | None = None


@dataclass
class Build:
    """What a build makes."""

    countries: DataFrame
    regions: DataFrame
    settlements: DataFrame
    plan: DataFrame
    placed: DataFrame
    counts: DataFrame


def plan_divisions(scan: Scan, wanted: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(plan, divisions, settlement ids, flagged entities)."""
    flags = classify.class_flags(scan.subclass)
    own = durable(classify.entity_flags(scan.entities, flags), "flags")
    entities = tiers.flagged(scan.entities, own)
    found = scan.entities.select("id", "dissolved", "end_time").join(own, "id", "left").filter(classify.settlement_test())
    settled = durable(found.select("id"), "settlements")
    countries = tiers.countries(scan.entities, wanted)
    plan, divisions = tiers.choose(entities, settled, countries, scan.located_in)
    return durable(plan, "plan"), durable(divisions, "divisions"), settled, entities


def _home():
    return F.regexp_extract("country", "^Q([0-9]+)$", 1).try_cast("bigint")


def place_all(scan: Scan, plan: DataFrame, divisions: DataFrame, settled: DataFrame) -> DataFrame:
    """placement.place over the scan."""
    assign = graph.nearest_seed(scan.located_in, tiers.seeds(plan, divisions))
    own = divisions.join(plan.filter("mode = 'admin1'").select("iso2"), "iso2", "left_semi")
    rescue = graph.rescue_walk(scan.located_in, scan.contains, own.select("qid").distinct())
    rows = scan.entities.join(settled, "id", "left_semi")
    lat, lng = parse_point(F.col("coord"))
    points = rows.select("id", lat.alias("lat"), lng.alias("lng")).filter("lat is not null and lng is not null")
    hits = spatial.locate(points, scan.polygons) if scan.polygons is not None else points.select("id", F.lit(None).cast("string").alias("code")).filter(F.lit(False))
    base = rows.select("id", _home().alias("home"), "same_as")
    return placement.place(base, assign, rescue, plan, own, hits)


def fall_back(scan: Scan, plan: DataFrame, divisions: DataFrame, settled: DataFrame, entities: DataFrame, placed: DataFrame):
    """(plan, divisions, changed): countries whose divisions held almost nothing get tier 4 or become one region.

    The decision is made on one row for each country.
    """
    counts = placement.placement_counts(placed).join(plan.filter("mode = 'admin1'"), "iso2").persist()
    weak = counts.filter("unheld >= 5 and seen - unheld < unheld")
    if weak.isEmpty():
        return plan, divisions, False
    named = durable(tiers.tier4(entities, settled, weak.select("iso2", "country_qid")), "tier4")
    got = tiers.claimed(scan.entities, settled, named).join(named.select(F.col("qid").alias("division"), "iso2"), "division")
    claimed = got.groupBy("iso2").agg(F.count(F.lit(1)).alias("claimed"))
    decided = tiers.attachment(counts.join(claimed, "iso2", "left").na.fill({"claimed": 0})).select("iso2", "decision").collect()
    claim = [r.iso2 for r in decided if r.decision == "claim"]
    flat = [r.iso2 for r in decided if r.decision == "flatten"]
    if not claim and not flat:
        return plan, divisions, False
    kept = divisions.filter(~F.col("iso2").isin(claim + flat))
    own = plan.filter(F.col("iso2").isin(flat)).select("iso2", F.col("country_qid").alias("qid"), F.lit(None).cast("string").alias("code"))
    divisions = durable(kept.union(named.filter(F.col("iso2").isin(claim)).select("iso2", "qid", "code")).union(own), "divisions")
    tier = F.when(F.col("iso2").isin(claim), 4).when(F.col("iso2").isin(flat), 5).otherwise(F.col("tier")).alias("tier")
    mode = F.when(F.col("iso2").isin(flat), "country").otherwise(F.col("mode")).alias("mode")
    return durable(plan.select("iso2", "country_qid", tier, mode), "plan"), divisions, True


def without_duplicates(placed: DataFrame, divisions: DataFrame) -> DataFrame:
    """placed without rows that were open before the rescues and are said to be a row that has a division."""
    candidates = placed.filter("was_open and size(same_as) > 0").select("id", "same_as")
    real = placed.join(divisions.select(F.col("qid").alias("division")).distinct(), "division", "left_semi").select("id")
    return placed.join(placement.duplicates(candidates, real), "id", "left_anti")


def translate_codes(scan: Scan, placed: DataFrame, plan: DataFrame, divisions: DataFrame) -> DataFrame:
    """placed, open rows inside a polygon whose code the placed ones have taught now with a division."""
    if scan.polygons is None:
        return placed
    lat, lng = parse_point(F.col("coord"))
    points = scan.entities.select("id", lat.alias("lat"), lng.alias("lng")).filter("lat is not null and lng is not null")
    points = points.join(placed.select("id"), "id", "left_semi")
    at = durable(points.join(spatial.locate(points, scan.polygons), "id").join(placed.select("id", "iso2", "division", "held"), "id"), "polygon-hits")
    real = divisions.select("iso2", F.col("qid").alias("division"))
    asked = at.filter("not held").select("iso2").distinct()
    samples = at.filter("held").join(real, ["iso2", "division"], "left_semi").join(asked, "iso2", "left_semi")
    learned = placement.learn_codes(samples.select("iso2", "id", "code", "division", "lat", "lng"), scan.polygons)
    new = placement.translate(at.filter("not held").select("iso2", "id", "code"), learned).withColumnRenamed("division", "new")
    j = placed.join(new, "id", "left")
    found = F.col("new").isNotNull()
    return j.withColumn("division", F.coalesce("new", "division")).withColumn("provenance", F.when(found, "boundary").otherwise(F.col("provenance"))).drop("new")


def assign_regions(placed: DataFrame, plan: DataFrame, divisions: DataFrame) -> DataFrame:
    """id, iso2, admin1_id, admin1_source: the division where it is the country's own, else the country itself."""
    own = divisions.select("iso2", F.col("qid").alias("division"), F.lit(True).alias("mine")).distinct()
    j = placed.join(plan, "iso2").join(own, ["iso2", "division"], "left")
    flat = F.col("mode") == "country"
    region = F.when(flat, F.col("country_qid")).when(F.col("mine"), F.col("division")).otherwise(F.col("country_qid"))
    j = j.withColumn("admin1_id", region)
    source = placement.admin1_source(F.col("admin1_id"), F.col("country_qid"), F.col("mode"), F.col("provenance") == "boundary")
    return j.select("id", "iso2", "admin1_id", source.alias("admin1_source"))


def build(spark: SparkSession, scan: Scan, wanted: tuple[str, ...] | None = None) -> Build:
    """Run every stage."""
    tiers.guard_scan(scan.entities)
    plan, divisions, settled, entities = plan_divisions(scan, wanted)
    placed = durable(place_all(scan, plan, divisions, settled), "placed")
    plan, divisions, changed = fall_back(scan, plan, divisions, settled, entities, placed)
    if changed:
        placed = durable(place_all(scan, plan, divisions, settled), "placed")
    counts = placement.placement_counts(placed)
    placed = durable(translate_codes(scan, without_duplicates(placed, divisions), plan, divisions), "placed")
    assigned = assign_regions(placed, plan, divisions)
    zones = scan.zones if scan.zones is not None else spark.createDataFrame([], "iso2 string, zone string")
    native = durable(assemble.official_languages(scan.entities, plan), "native")
    facts = plan.select("iso2", "country_qid").join(native, "iso2", "left").join(zones, "iso2", "left")
    rows = scan.entities.join(assigned, "id").join(facts.select("iso2", "native", "zone"), "iso2", "left")
    found = assemble.settlement_rows(rows)
    found = durable(assemble.first_of(found.filter("reject is null").drop("reject"), "id", "country_code", "admin1_id"), "rows")
    group = found.groupBy("admin1_id", "slug").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    asked = found.join(group, ["admin1_id", "slug"], "left_semi").select("admin2_id", "country_code").distinct()
    asked = asked.join(facts.select(F.col("iso2").alias("country_code"), "native"), "country_code", "left")
    labels = assemble.parent_labels(scan.entities, asked)
    named = found.join(labels, ["admin2_id", "country_code"], "left").select(*found.columns, "parent_label")
    settlements = durable(collisions.resolve_collisions(named), "settled")
    used = settlements.select(F.col("admin1_id").alias("qid"), F.col("country_code").alias("iso2")).distinct()
    coarse = used.join(divisions.select("qid"), "qid", "left_anti").select("iso2", "qid", F.lit(None).cast("string").alias("code"))
    emit = divisions.select("iso2", "qid", "code").union(coarse)
    base = scan.entities.join(facts.withColumnRenamed("country_qid", "id"), "id")
    country = assemble.country_names(base)
    names = country.select("iso2", "country_name")
    records = emit.select("iso2", F.col("qid").alias("id"), F.col("code").alias("iso_code")).join(scan.entities, "id", "left")
    records = records.join(facts.select("iso2", "native", "zone"), "iso2", "left").join(names, "iso2", "left")
    regions = durable(assemble.region_rows(records, plan, settlements), "regions")
    settlements = settlements.join(regions.select(F.col("id").alias("admin1_id"), "country_code"), ["admin1_id", "country_code"], "left_semi")
    settlements = settlements.select(*assemble.SETTLEMENT_KEYS)
    return Build(assemble.country_rows(country, scan.entities), regions, settlements, plan, placed, counts)


def stats(b: Build, elapsed: float | None = None) -> dict:
    """Totals and per-country counters; a few hundred rows reach the driver."""
    per = b.counts.join(b.plan, "iso2").orderBy("iso2").collect()
    own = F.col("admin1_id") == F.col("country_qid")
    held = b.settlements.join(b.plan.select(F.col("iso2").alias("country_code"), "country_qid"), "country_code")
    shipped = {r.country_code: r for r in held.groupBy("country_code").agg(F.count(F.lit(1)).alias("n"), F.count_if(own).alias("own")).collect()}
    rows = []
    for r in per:
        got = shipped.get(r.iso2)
        rows.append({
            "code": r.iso2, "cities": got.n if got else 0, "country_region": got.own if got else 0, "tier": r.tier, "mode": r.mode,
            "settlements_seen": r.seen, "orphans": r.orphans, "unheld": r.unheld,
            "placed_by_contains": r.by_contains, "placed_by_boundary": r.by_boundary,
        })
    total = lambda k: sum(r[k] for r in rows)
    out = {"countries": rows, "cities_total": total("cities"), "in_country_region": total("country_region"), "divisions_selected": b.regions.count()}
    out |= {k: total(k) for k in ("placed_by_contains", "placed_by_boundary")}
    return out if elapsed is None else out | {"elapsed_seconds": round(elapsed, 1)}
