"""Which divisions a country gets: five tiers, the first that answers wins.

Tiers are DataFrames over all countries at once; later ones are joined only with the countries that have no
answer yet. The plan table has a row for each country, the division table one for each of its divisions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeforge import constants as K
from placeforge.functions.columns import with_prefix
from placeforge.operators.classify import excluded_division, gone, has_class, is_country, not_a_place
from placeforge.operators.graph import ancestors, nearest_seed


def countries(entities: DataFrame, wanted: tuple[str, ...] | None = None) -> DataFrame:
    """iso2, country_qid: the lowest item of each ISO 3166-1 code, without countries that are gone."""
    rows = entities.select("id", F.explode("iso_3166_1").alias("iso2"), "dissolved", "end_time")
    lowest = rows.groupBy("iso2").agg(F.min_by(F.struct("id", "dissolved", "end_time"), "id").alias("r")).select("iso2", "r.*")
    out = lowest.filter(~gone()).select("iso2", F.col("id").alias("country_qid"))
    return out.filter(F.col("iso2").isin([c.strip().upper() for c in wanted])) if wanted else out


def guard_scan(entities: DataFrame) -> None:
    """Stop on a scan whose country records mostly lack a capital."""
    r = entities.filter(is_country()).agg(F.count(F.lit(1)).alias("n"), F.count("capital").alias("c")).first()
    if r.n and r.c < K.MIN_SCAN_CAPITALS * r.n:
        raise ValueError(f"only {r.c} of {r.n} country records carry a capital")


def flagged(entities: DataFrame, flags: DataFrame) -> DataFrame:
    """entities with the booleans not_place and admin_class of entity_flags."""
    f = flags.select("id", "not_a_place", "admin")
    return entities.join(f, "id", "left").withColumn("not_place", not_a_place(F.col("not_a_place"))).withColumn("admin_class", F.coalesce("admin", F.lit(False)))


def _live(dates: bool = True, hand: bool = True) -> Column:
    """What tiers ask of a division: no country, a place, and (where asked) alive and not excluded by hand."""
    ok = ~is_country() & ~F.col("not_place")
    if dates:
        ok &= ~excluded_division()
    if hand:
        ok &= ~F.col("id").isin(*K.REGION_EXCLUDE_QIDS) & ~F.coalesce(has_class(K.REGION_EXCLUDE_CLASSES), F.lit(False))
    return ok


def coded(entities: DataFrame, plan: DataFrame) -> DataFrame:
    """entities once for each country whose prefix one of their codes has: iso2, codes, code (the least)."""
    one = entities.withColumn("iso2", F.explode(F.array_distinct(F.transform("iso_3166_2", lambda x: F.substring_index(x, "-", 1)))))
    one = one.join(plan.select("iso2"), "iso2", "left_semi")
    return one.withColumn("codes", with_prefix(F.col("iso_3166_2"), F.col("iso2"))).filter(F.size("codes") > 0).withColumn("code", F.array_min("codes"))


def tier1(entities: DataFrame, plan: DataFrame, edges: DataFrame) -> DataFrame:
    """iso2, qid, code: divisions with a code of the country, one (the lowest) for each code, root-most."""
    banned = F.array(*[F.lit(c) for c in K.REGION_EXCLUDE_CODES])
    rows = coded(entities, plan).filter(_live() & ~F.arrays_overlap("codes", banned))
    return keep_root_most(lowest_by_code(rows.select("iso2", F.col("id").alias("qid"), "code")), edges)


def lowest_by_code(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("iso2", "code").orderBy("qid")
    return rows.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def keep_root_most(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """rows (iso2, qid, …) without those below another of the same country."""
    above = ancestors(edges, rows.select("qid").distinct()).filter("qid <> ancestor")
    inner = rows.select("iso2", "qid").join(above, "qid").join(rows.select("iso2", F.col("qid").alias("ancestor")), ["iso2", "ancestor"], "left_semi")
    return rows.join(inner.select("iso2", "qid").distinct(), ["iso2", "qid"], "left_anti")


def tier2(entities: DataFrame, plan: DataFrame, edges: DataFrame) -> DataFrame:
    """Direct children of the country item with an administrative class; no code, no root-most rule."""
    kids = edges.join(plan.select("iso2", F.col("country_qid").alias("parent")), "parent").select("iso2", F.col("child").alias("id")).distinct()
    rows = kids.join(entities, "id").filter(_live() & F.col("admin_class"))
    return rows.select("iso2", F.col("id").alias("qid"), F.lit(None).cast("string").alias("code"))


def tier3(entities: DataFrame, plan: DataFrame, edges: DataFrame) -> DataFrame:
    """As tier 1 with divisions that are gone and without the hand-kept exclusions or one for each code."""
    rows = coded(entities, plan).filter(_live(dates=False, hand=False))
    return keep_root_most(rows.select("iso2", F.col("id").alias("qid"), "code"), edges)


def shard_edges(entities: DataFrame) -> DataFrame:
    """shard (the country a record states), child, parent from the records' own containment lists."""
    home = F.regexp_extract("country", "^Q([0-9]+)$", 1).try_cast("bigint")
    refs = F.filter("located_in", lambda x: x.rlike("^Q[0-9]+$"))
    e = entities.select(home.alias("shard"), F.col("id").alias("child"), F.explode(refs).alias("p"))
    return e.select("shard", "child", F.col("p").substr(2, 20).cast("long").alias("parent"))


def tier4(entities: DataFrame, settlement_ids: DataFrame, plan: DataFrame) -> DataFrame:
    """Divisions that a country's settlements name: containers with an administrative class above them, root-most,
    all within the records that state the country."""
    home = F.regexp_extract("country", "^Q([0-9]+)$", 1).try_cast("bigint")
    own = entities.withColumn("shard", home).join(plan.select("iso2", F.col("country_qid").alias("shard")), "shard")
    e = shard_edges(entities).join(own.select("shard", F.col("id").alias("child")), ["shard", "child"], "left_semi").select("child", "parent")
    mine = own.join(settlement_ids.select("id"), "id", "left_semi").select("iso2", F.col("id").alias("qid"))
    up = ancestors(e, mine.select("qid").distinct()).select("qid", "ancestor")
    named = up.join(mine, "qid").select("iso2", F.col("ancestor").alias("id")).distinct()
    named = named.join(settlement_ids.select("id"), "id", "left_anti")
    rows = named.join(own.drop("iso2", "shard"), "id").filter(_live() & F.col("admin_class"))
    picked = rows.select("iso2", F.col("id").alias("qid"), F.lit(None).cast("string").alias("code"))
    return keep_root_most(picked, e)


def claimed(entities: DataFrame, settlement_ids: DataFrame, divisions: DataFrame) -> DataFrame:
    """qid, depth, division: settlements under tier-4 divisions by the records' own lists, nearest first."""
    e = shard_edges(entities).select("child", "parent")
    got = nearest_seed(e, divisions.select("qid", F.lit(0).alias("depth"), F.col("qid").alias("division")))
    return got.join(settlement_ids.select(F.col("id").alias("qid")), "qid", "left_semi")


def tier5(plan: DataFrame) -> DataFrame:
    """The country itself as its only region."""
    return plan.select("iso2", F.col("country_qid").alias("qid"), F.lit(None).cast("string").alias("code"))


def choose(entities: DataFrame, settlement_ids: DataFrame, plan: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(plan with tier and mode, divisions iso2/qid/code): each country by its first tier with an answer.

    Every tier is computed for the countries that are still without one.
    """
    found, left = None, plan
    for tier, f in enumerate(
        (
            lambda p: tier1(entities, p, edges),
            lambda p: tier2(entities, p, edges),
            lambda p: tier3(entities, p, edges),
            lambda p: tier4(entities, settlement_ids, p),
            tier5,
        ),
        1,
    ):
        rows = f(left).select("iso2", "qid", "code").withColumn("tier", F.lit(tier)).persist()
        found = rows if found is None else found.union(rows)
        left = left.join(rows.select("iso2").distinct(), "iso2", "left_anti").persist()
        if left.isEmpty():
            break
    by = found.groupBy("iso2").agg(F.min("tier").alias("tier"))
    mode = F.when(F.col("tier") == 5, "country").otherwise("admin1").alias("mode")
    return plan.join(by, "iso2").select("iso2", "country_qid", "tier", mode), found.select("iso2", "qid", "code")


def seeds(plan: DataFrame, divisions: DataFrame) -> DataFrame:
    """qid, depth, division: divisions at their own depth, and each admin1 country further out as a last resort."""
    own = divisions.select("qid", F.lit(K.LEAF_OFFSET).alias("depth"), F.col("qid").alias("division"))
    coarse = plan.filter("mode = 'admin1'").select(F.col("country_qid").alias("qid"), F.lit(K.COUNTRY_OFFSET).alias("depth"), F.col("country_qid").alias("division"))
    return own.union(coarse)


def tier_histogram(plan: DataFrame) -> DataFrame:
    return plan.groupBy("tier").agg(F.count(F.lit(1)).alias("countries"))


def attachment(counts: DataFrame) -> DataFrame:
    """iso2, decision of the fallback: keep, claim (if tier 4 placed enough) or flatten.

    counts: iso2, seen, unheld (no division), orphans (no region at all), claimed (placed by tier 4).
    """
    attached = F.col("seen") - F.col("unheld")
    weak = (F.col("unheld") >= 5) & (attached < F.col("unheld"))
    enough = F.col("claimed") >= F.greatest(attached * 2, attached + 5)
    flat = (F.col("seen") - F.col("orphans")) < 0.25 * F.col("orphans")
    decision = F.when(~weak, "keep").when((F.col("claimed") > 0) & enough, "claim").when(flat, "flatten").otherwise("keep")
    return counts.withColumn("decision", decision)
