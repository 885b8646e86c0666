"""Placing settlements: stated containment, the parent's statement, boundaries, and the country as a last resort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeforge.constants import MIN_PURITY, MIN_SUPPORT
from placeforge.operators.graph import ids
from placeforge.operators.spatial import well_inside


def place(settlements: DataFrame, assign: DataFrame, contains_assign: DataFrame, plan: DataFrame, divisions: DataFrame, hits: DataFrame) -> DataFrame:
    """One row for each settlement that a country can take.

    settlements: id, home (the country item it states), same_as; assign and contains_assign: qid, division;
    plan: iso2, country_qid, mode; divisions: iso2, qid, code; hits: id, code of the polygon around it.
    Result: id, iso2, division, provenance (stated, contains, boundary or none), held, orphan, was_open and
    same_as.

    The three small tables are a few thousand rows for a world; joins on them are broadcast by their size.
    """
    # A division with codes of two countries belongs to the first by code.
    owner = divisions.groupBy(F.col("qid").alias("division")).agg(F.min("iso2").alias("d_iso2"))
    country = plan.select(F.col("country_qid").alias("division"), F.col("iso2").alias("c_iso2"), (F.col("mode") == "admin1").alias("level"))
    home = plan.select(F.col("country_qid").alias("home"), F.col("iso2").alias("h_iso2"), F.col("mode").alias("h_mode"))
    better = contains_assign.select(F.col("qid").alias("id"), F.col("division").alias("b_division"))
    better = better.join(owner.select(F.col("division").alias("b_division"), F.col("d_iso2").alias("b_iso2")), "b_division")
    coded = divisions.filter(F.col("code").isNotNull()).select(F.col("iso2").alias("x_iso2"), F.col("code").alias("x_code"), F.col("qid").alias("x_division"))
    s = settlements.join(assign.select(F.col("qid").alias("id"), "division"), "id", "left")
    s = s.join(owner, "division", "left").join(country, "division", "left").join(home, "home", "left")
    s = s.join(better, "id", "left").join(hits.select("id", F.col("code").alias("x_code")), "id", "left")
    is_open = F.col("division").isNull() | F.coalesce("level", F.lit(False))
    own = F.coalesce("d_iso2", "c_iso2")
    s = s.withColumn("was_open", is_open).withColumn("own_iso2", own).withColumn("home_iso2", F.coalesce(own, "h_iso2"))
    s = s.join(coded, (F.col("home_iso2") == F.col("x_iso2")) & (s["x_code"] == coded["x_code"]), "left")
    rescue = is_open & F.col("b_division").isNotNull() & (F.col("b_iso2") == F.col("home_iso2"))
    inside = is_open & ~F.coalesce(rescue, F.lit(False)) & F.col("x_division").isNotNull()
    new = F.when(rescue, F.col("b_division")).when(inside, F.col("x_division")).otherwise(F.col("division"))
    source = F.when(rescue, "contains").when(inside, "boundary").when(~is_open, "stated").otherwise("none")
    iso2 = F.when(rescue | inside, F.col("home_iso2")).otherwise(own)
    flat = F.when(F.col("h_mode") == "country", F.col("h_iso2"))
    out = s.select(
        "id",
        F.coalesce(iso2, flat, "h_iso2").alias("iso2"),
        new.alias("division"),
        source.alias("provenance"),
        (source != "none").alias("held"),
        F.coalesce(iso2, flat).isNull().alias("orphan"),
        "was_open",
        "same_as",
        F.col("home_iso2").alias("home_iso2"),
    )
    return out.filter(F.col("iso2").isNotNull())


def placement_counts(placed: DataFrame) -> DataFrame:
    """Counts for each country: seen, orphans, unheld, by contains and by boundary."""
    return placed.groupBy("iso2").agg(
        F.count(F.lit(1)).alias("seen"),
        F.count_if("orphan").alias("orphans"),
        F.count_if(~F.col("held")).alias("unheld"),
        F.count_if(F.col("provenance") == "contains").alias("by_contains"),
        F.count_if(F.col("provenance") == "boundary").alias("by_boundary"),
    )


def duplicates(candidates: DataFrame, placed: DataFrame) -> DataFrame:
    """id, duplicate_of: candidates (id, same_as) said to be the same as something placed; its first such target.

    placed: id of the rows that ended in a real division.
    """
    refs = candidates.select("id", F.posexplode(ids("same_as")).alias("pos", "target"))
    hit = refs.join(placed.select(F.col("id").alias("target")).distinct(), "target")
    return hit.groupBy("id").agg(F.min_by("target", "pos").alias("duplicate_of"))


def _winners(votes: DataFrame, purity: float, support: int) -> DataFrame:
    """votes: iso2, code, division, n -> the leading division of each code, its total, and whether it passes."""
    by = Window.partitionBy("iso2", "code")
    lead = votes.withColumn("total", F.sum("n").over(by)).withColumn("rn", F.row_number().over(by.orderBy(F.desc("n"), "division")))
    return lead.filter("rn = 1").select("iso2", "code", "division", "n", "total", ((F.col("total") >= support) & (F.col("n") >= purity * F.col("total"))).alias("ok"))


def vote(samples: DataFrame, inner: DataFrame | None = None, purity: float = MIN_PURITY, support: int = MIN_SUPPORT) -> DataFrame:
    """iso2, code, division learned from placed settlements (iso2, id, code, division).

    A code with support but not purity is asked again with `inner`, the samples clear of the polygon's edge.
    """
    count = lambda df: df.groupBy("iso2", "code", "division").agg(F.count(F.lit(1)).alias("n"))
    first = _winners(count(samples), purity, support)
    out = first.filter("ok").select("iso2", "code", "division")
    if inner is None:
        return out
    failed = first.filter(~F.col("ok") & (F.col("total") >= support)).select("iso2", "code")
    second = _winners(count(inner.join(failed, ["iso2", "code"], "left_semi")), purity, support)
    return out.union(second.filter("ok").select("iso2", "code", "division"))


def learn_codes(samples: DataFrame, polygons: DataFrame) -> DataFrame:
    """vote() with the interior question put to polygons; samples also have lat and lng.

    Only codes that the cheap question turned down are looked at again.
    """
    count = samples.groupBy("iso2", "code", "division").agg(F.count(F.lit(1)).alias("n"))
    failed = _winners(count, MIN_PURITY, MIN_SUPPORT).filter(f"not ok and total >= {MIN_SUPPORT}").select("iso2", "code")
    rows = samples.join(failed, ["iso2", "code"], "left_semi")
    return vote(samples, well_inside(rows, polygons))


def translate(open_rows: DataFrame, learned: DataFrame) -> DataFrame:
    """id, division for rows without one (iso2, id, code) by what the codes mean."""
    return open_rows.join(learned, ["iso2", "code"]).select("id", "division")


def admin1_source(division: Column, country_qid: Column, mode: Column, from_boundary: Column) -> Column:
    """Where a row's region comes from: none for the country itself, else boundary or stated."""
    return F.when((division == country_qid) & (mode != "country"), "none").when(from_boundary, "boundary").otherwise("stated")
