"""From placed settlements to flat country, region and settlement tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from placeforge import constants as K
from placeforge.functions.columns import country_tld, first_reference, flag, parse_float, parse_int, parse_point, reference
from placeforge.functions.naming import alt_names_column, qualifier_column, resolve_column
from placeforge.functions.text import fixed_column, fold_column, mean_point, slug_column
from placeforge.operators.graph import ids

SETTLEMENT_KEYS = (
    "id", "source", "admin1_id", "admin1_source", "country_code", "name", "name_lang", "slug", "latitude", "longitude",
    "population", "place_type", "geonames_id", "timezone", "postal_code", "elevation", "native_label", "alt_names",
    "area", "osm_relation_id", "capital_of", "sitelinks", "admin2_id", "timezone_id",
)
REGION_KEYS = (
    "id", "source", "country_code", "name", "slug", "name_lang", "iso_3166_2", "sole", "unassigned", "latitude",
    "longitude", "population", "place_type", "geonames_id", "timezone", "timezone_id", "postal_code", "elevation",
    "native_label", "alt_names", "area", "osm_relation_id", "capital_of", "sitelinks", "admin2_id",
)
COUNTRY_KEYS = (
    "id", "source", "code", "name", "slug", "iso_3166_1_alpha3", "iso_3166_1_numeric", "calling_code", "currency_id",
    "currency_code", "currency_name", "currency_symbol", "capital_id", "capital_name", "continent_id",
    "continent_name", "demonym", "tld", "flag_emoji", "timezone_id", "official_language", "population", "area",
)


def official_languages(entities: DataFrame, countries: DataFrame) -> DataFrame:
    """iso2, native: the least language code among a country's official languages."""
    codes = entities.filter("wm_lang_code is not null").select(F.col("id").alias("lang"), "wm_lang_code")
    own = entities.join(countries.select("iso2", F.col("country_qid").alias("id")), "id")
    each = own.select("iso2", F.explode(ids("official_language")).alias("lang")).join(codes, "lang")
    return each.groupBy("iso2").agg(F.min("wm_lang_code").alias("native"))


def extra_fields(native: Column, zone: Column, lang: Column, original: Column) -> list[Column]:
    """The block that settlements and regions share, from an entity's columns."""
    none = F.array().cast("array<string>")
    first = lambda c: reference(F.get(F.col(c), F.lit(0))).alias
    return [
        parse_int(F.col("population")).alias("population"),
        first("instance_of")("place_type"),
        parse_int(F.col("geonames_id")).alias("geonames_id"),
        reference(F.col("timezone")).alias("timezone"),
        F.nullif(F.col("postal_code"), F.lit("")).alias("postal_code"),
        parse_float(F.col("elevation")).alias("elevation"),
        F.array_sort(F.coalesce("native_label", none)).alias("native_label"),
        alt_names_column(F.col("alt_labels"), native, lang, original).alias("alt_names"),
        parse_float(F.col("area")).alias("area"),
        parse_int(F.col("osm_relation_id")).alias("osm_relation_id"),
        reference(F.col("capital_of")).alias("capital_of"),
        F.lit(None).cast("long").alias("sitelinks"),
        first("located_in")("admin2_id"),
        zone.alias("timezone_id"),
    ]


def settlement_rows(placed: DataFrame) -> DataFrame:
    """placed (entity columns plus iso2, admin1_id, admin1_source, native, zone) as settlement rows.

    Adds reject (no_label, no_coord or null), in that order of questions, and upstream_qualifier.
    """
    r = placed.withColumn("n", resolve_column(F.col("labels"), F.col("native")))
    lat, lng = parse_point(F.col("coord"))
    r = r.withColumn("latitude", fixed_column(lat)).withColumn("longitude", fixed_column(lng))
    r = r.withColumn("clean", F.trim(fold_column(F.col("n.name"))))
    unnamed = F.col("n.name").isNull() | F.col("n.name").rlike(r"^Q\d+$")
    empty = (F.coalesce("clean", F.lit("")) == "") | (F.coalesce(slug_column(F.col("clean")), F.lit("")) == "") | ~F.col("clean").rlike("[A-Za-z]")
    reject = F.when(unnamed, "no_label").when(F.col("latitude").isNull() | F.col("longitude").isNull(), "no_coord").when(empty, "no_label")
    r = r.withColumn("reject", reject).withColumn("q", qualifier_column(F.col("clean")))
    extra = extra_fields(F.col("native"), F.col("zone"), F.col("n.lang"), F.col("n.original"))
    return r.select(
        "id", F.lit(K.SOURCE).alias("source"), "admin1_id", "admin1_source", F.col("iso2").alias("country_code"),
        F.col("q.head").alias("name"), F.col("n.lang").alias("name_lang"), slug_column(F.col("q.head")).alias("slug"),
        "latitude", "longitude", *extra, F.col("q.qualifier").alias("upstream_qualifier"), "reject",
    )


def parent_labels(entities: DataFrame, wanted: DataFrame) -> DataFrame:
    """admin2_id, country_code, parent_label: short names of the parents that colliding rows name.

    wanted: admin2_id, country_code, native. A parent's own bracket comes off.
    """
    w = wanted.filter("admin2_id is not null").distinct()
    j = w.join(entities.select(F.concat(F.lit("Q"), F.col("id")).alias("admin2_id"), "labels"), "admin2_id")
    name = F.nullif(F.trim(fold_column(resolve_column(F.col("labels"), F.col("native"))["name"])), F.lit(""))
    return j.withColumn("parent_name", name).select("admin2_id", "country_code", qualifier_column(F.col("parent_name"))["head"].alias("parent_label"))


@F.pandas_udf(StructType([StructField("latitude", StringType()), StructField("longitude", StringType())]))
def _mean_udf(points: pd.Series) -> pd.DataFrame:
    rows = [mean_point((p["latitude"], p["longitude"]) for p in ps) if ps is not None else (None, None) for ps in points]
    return pd.DataFrame(rows, columns=["latitude", "longitude"], dtype=object)


def mean_coordinates(settlements: DataFrame, regions: DataFrame) -> DataFrame:
    """admin1_id, latitude, longitude: means of the settlements of the given regions, summed in order of name and id."""
    rows = settlements.join(regions.select("admin1_id"), "admin1_id", "left_semi")
    g = rows.groupBy("admin1_id").agg(F.array_sort(F.collect_list(F.struct("name", "id", "latitude", "longitude"))).alias("p"))
    return g.select("admin1_id", _mean_udf("p").alias("m")).select("admin1_id", "m.latitude", "m.longitude")


def first_of(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row for each key: the first in the given order."""
    turn = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("__turn", turn).filter("__turn = 1").drop("__turn")


def sole_flags(is_country: Column, country: str, flat: Column | None = None) -> tuple[Column, Column]:
    """(sole, unassigned) of a region that is the country itself: whether it is the country's only one."""
    alone = F.count(F.lit(1)).over(Window.partitionBy(country)) == 1
    sole = alone if flat is None else flat | alone
    return is_country & sole, is_country & ~sole


def region_rows(records: DataFrame, plan: DataFrame, settlements: DataFrame) -> DataFrame:
    """Region rows from division records (entity columns plus iso2, iso_code, native, zone, country_name).

    plan: iso2, country_qid, mode. A region without a name is left out, and with it its settlements.
    """
    r = records.join(plan.select("iso2", "country_qid", "mode"), "iso2")
    sole, unassigned = sole_flags(F.col("id") == F.col("country_qid"), "iso2", F.col("mode") == "country")
    r = r.withColumn("sole", sole).withColumn("unassigned", unassigned)
    r = r.withColumn("n", resolve_column(F.col("labels"), F.col("native")))
    flat = F.col("mode") == "country"
    r = r.withColumn("name0", F.when(flat, F.col("country_name")).otherwise(F.col("n.name"))).filter(F.coalesce("name0", F.lit("")) != "")
    r = r.withColumn("name", F.coalesce(F.nullif(fold_column(F.col("name0")), F.lit("")), F.col("name0")))
    lat, lng = parse_point(F.col("coord"))
    r = r.withColumn("lat0", fixed_column(lat)).withColumn("lng0", fixed_column(lng))
    bare = r.filter("lat0 is null or lng0 is null").select(F.col("id").alias("admin1_id"))
    mean = mean_coordinates(settlements, bare).select(F.col("admin1_id").alias("id"), F.col("latitude").alias("m_lat"), F.col("longitude").alias("m_lng"))
    r = r.join(mean, "id", "left")
    point = F.col("lat0").isNotNull() & F.col("lng0").isNotNull()
    extra = extra_fields(F.col("native"), F.col("zone"), F.col("n.lang"), F.col("n.original"))
    return r.select(
        "id", F.lit(K.SOURCE).alias("source"), F.col("iso2").alias("country_code"), "name", slug_column(F.col("name")).alias("slug"),
        F.when(~flat, F.col("n.lang")).alias("name_lang"), F.col("iso_code").alias("iso_3166_2"),
        "sole", "unassigned",
        F.when(point, F.col("lat0")).otherwise(F.col("m_lat")).alias("latitude"),
        F.when(point, F.col("lng0")).otherwise(F.col("m_lng")).alias("longitude"), *extra,
    ).select(*REGION_KEYS)


def country_names(records: DataFrame) -> DataFrame:
    """records (entity columns plus iso2, native) with country_name: the fixed spelling, the resolved name, the code."""
    fixed = F.create_map(*[F.lit(x) for kv in K.COUNTRY_NAME_OVERRIDES.items() for x in kv])
    name = resolve_column(F.col("labels"), F.col("native"))["name"]
    return records.withColumn("country_name", F.coalesce(F.try_element_at(fixed, F.col("iso2")), name, F.col("iso2")))


def country_rows(records: DataFrame, entities: DataFrame) -> DataFrame:
    """Country rows from country records (entity columns plus iso2, native, zone, country_name).

    The three looked-up items are left joins on ids; at most a few hundred countries ask.
    """
    r = records
    for field in ("currency", "capital", "continent"):
        r = r.withColumn(f"{field}_ref", first_reference(F.col(field)))
    wanted = r.select(F.explode(F.array("currency_ref", "capital_ref", "continent_ref")).alias("id")).distinct()
    items = entities.join(wanted, "id", "left_semi").select("id", "labels", "currency_code", "unit_symbol").persist()
    for field in ("currency", "capital", "continent"):
        i = items.select(F.col("id").alias(f"{field}_ref"), F.col("labels").alias(f"{field}_labels"), F.col("currency_code").alias(f"{field}_code0"), F.col("unit_symbol").alias(f"{field}_unit"))
        r = r.join(i, f"{field}_ref", "left")
        r = r.withColumn(f"{field}_name", fold_column(resolve_column(F.col(f"{field}_labels"), F.col("native"))["name"]))
    ref = lambda c: F.concat(F.lit("Q"), F.col(f"{c}_ref")).alias(f"{c}_id")
    demonym = F.coalesce(F.try_element_at(F.col("demonym"), F.lit("en")), F.try_element_at(F.col("demonym"), F.col("native")))
    none = F.array().cast("array<string>")
    return r.select(
        "id", F.lit(K.SOURCE).alias("source"), F.col("iso2").alias("code"), F.col("country_name").alias("name"),
        slug_column(F.col("country_name")).alias("slug"), "iso_3166_1_alpha3", "iso_3166_1_numeric",
        F.array_sort(F.coalesce("calling_code", none)).alias("calling_code"), ref("currency"),
        F.col("currency_code0").alias("currency_code"), "currency_name", F.col("currency_unit").alias("currency_symbol"),
        ref("capital"), "capital_name", ref("continent"), "continent_name", fold_column(demonym).alias("demonym"),
        country_tld(F.col("iso2")).alias("tld"), flag(F.col("iso2")).alias("flag_emoji"), F.col("zone").alias("timezone_id"),
        F.col("native").alias("official_language"), parse_int(F.col("population")).alias("population"), parse_float(F.col("area")).alias("area"),
    ).select(*COUNTRY_KEYS)
