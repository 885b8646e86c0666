"""Gates between a build and its baseline; each is one row: gate, value, threshold, ok."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge import constants as K
from placeforge.functions.text import slug_column


def _gate(df: DataFrame, name: str, value: Column, threshold: float, ok) -> DataFrame:
    v = F.coalesce(value.cast("double"), F.lit(0.0))
    return df.select(F.lit(name).alias("gate"), v.alias("value"), F.lit(float(threshold)).alias("threshold"), ok(v, threshold).alias("ok"))


def most(v: Column, t: float) -> Column:
    return v <= t


def least(v: Column, t: float) -> Column:
    return v >= t


def coverage(settlements: DataFrame) -> DataFrame:
    """Share of rows with both coordinates; 1 without rows."""
    both = (F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).cast("int")
    return _gate(settlements.agg(F.coalesce(F.avg(both), F.lit(1.0)).alias("v")), "coordinate coverage", F.col("v"), K.MIN_COVERAGE, least)


def compare(baseline: DataFrame, build: DataFrame) -> DataFrame:
    """code, old, new, ratio over the full join of two manifests (code, settlements)."""
    old, new = (d.select("code", F.col("settlements").alias(n)) for d, n in ((baseline, "old"), (build, "new")))
    j = old.join(new, "code", "full_outer").select("code", F.coalesce("old", F.lit(0)).alias("old"), F.coalesce("new", F.lit(0)).alias("new"))
    return j.withColumn("ratio", F.when(F.col("old") > 0, F.col("new") / F.col("old")))


def losses(baseline: DataFrame, build: DataFrame) -> DataFrame:
    """Countries and settlements lost against the baseline, as shares."""
    j = baseline.select("code").join(build.select("code"), "code", "left_anti")
    lost = j.agg(F.count(F.lit(1)).alias("l")).crossJoin(baseline.agg(F.count(F.lit(1)).alias("n")))  # one row each
    total = baseline.agg(F.sum("settlements").alias("o")).crossJoin(build.agg(F.coalesce(F.sum("settlements"), F.lit(0)).alias("n")))
    countries = _gate(lost, "country loss", F.col("l") / F.nullif(F.col("n"), F.lit(0)), K.MAX_COUNTRY_LOSS, most)
    cities = _gate(total, "settlement loss", (F.col("o") - F.col("n")) / F.nullif(F.col("o"), F.lit(0)), K.MAX_CITY_LOSS, most)
    return countries.union(cities)


def regressions(baseline: DataFrame, build: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """code, old, new, ratio, blocking: countries below the ratio, worst first."""
    low = compare(baseline, build).filter((F.col("old") > 0) & (F.col("ratio") < K.MIN_CITY_RATIO))
    if allowed is None:
        return low.withColumn("blocking", F.lit(True)).orderBy("ratio", "code")
    a = allowed.select("code", F.lit(True).alias("__a"))
    return low.join(a, "code", "left").withColumn("blocking", F.col("__a").isNull()).drop("__a").orderBy("ratio", "code")


def capital_presence(countries: DataFrame, settlements: DataFrame) -> DataFrame:
    """code, capital_name, present: whether a country's capital is among its settlements, by slug."""
    named = countries.filter("capital_name <> ''").select("code", "capital_name", slug_column(F.col("capital_name")).alias("slug"))
    have = settlements.select(F.col("country_code").alias("code"), "slug", F.lit(True).alias("present")).distinct()
    return named.join(have, ["code", "slug"], "left").select("code", "capital_name", F.coalesce("present", F.lit(False)).alias("present"))


def capitals(countries: DataFrame, settlements: DataFrame) -> DataFrame:
    """The two gates on capitals: how many countries name one, and how many of those are missing."""
    named = countries.agg(F.avg(F.coalesce((F.col("capital_name") != "").cast("int"), F.lit(0))).alias("v"))
    missing = capital_presence(countries, settlements).agg(F.avg((~F.col("present")).cast("int")).alias("v"))
    return _gate(named, "capitals named", F.col("v"), K.MIN_NAMED_CAPITALS, least).union(_gate(missing, "capitals missing", F.col("v"), K.MAX_MISSING_CAPITALS, most))


def run_gates(countries: DataFrame, settlements: DataFrame, build: DataFrame, baseline: DataFrame | None = None, allowed: DataFrame | None = None) -> DataFrame:
    """All gates; those against a baseline only where there is one."""
    parts = [coverage(settlements), capitals(countries, settlements)]
    if baseline is not None:
        low = regressions(baseline, build, allowed).agg(F.count_if("blocking").alias("v"))
        parts += [losses(baseline, build), _gate(low, "countries below ratio", F.col("v"), 0, most)]
    return reduce(DataFrame.union, parts)


def snapshot_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """code, change between two snapshots (code, settlements, regions, sha): dropped, added, counts or bytes; structure first."""
    cols = ("settlements", "regions", "sha")
    a = old.select("code", F.struct(*cols).alias("a"))
    b = new.select("code", F.struct(*cols).alias("b"))
    j = a.join(b, "code", "full_outer")
    counts = (F.col("a.settlements") != F.col("b.settlements")) | (F.col("a.regions") != F.col("b.regions"))
    change = F.when(F.col("b").isNull(), "dropped").when(F.col("a").isNull(), "added").when(counts, "counts").when(F.col("a.sha") != F.col("b.sha"), "bytes")
    rank = F.when(change.isin("dropped", "added"), 0).when(change == "counts", 1).otherwise(2)
    return j.select("code", change.alias("change"), rank.alias("rank")).filter("change is not null").orderBy("rank", "code")
