"""Schemas of what is read and written; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, LongType, MapType, StringType, StructField, StructType

_TEXT, _LIST = StringType(), ArrayType(StringType())
_LISTS = (
    "instance_of", "subclass_of", "located_in", "same_as", "native_label", "official_language", "iso_3166_2",
    "iso_3166_1", "capital", "continent", "currency", "tld", "calling_code",
)
_SCALARS = (
    "coord", "country", "population", "geonames_id", "timezone", "postal_code", "elevation", "area",
    "osm_relation_id", "capital_of", "dissolved", "end_time", "wm_lang_code", "iso_3166_1_alpha3",
    "iso_3166_1_numeric", "currency_code", "unit_symbol",
)

ENTITY = StructType(
    [
        StructField("id", LongType()),
        StructField("labels", MapType(_TEXT, _TEXT)),
        StructField("alt_labels", MapType(_TEXT, _LIST)),
        StructField("demonym", MapType(_TEXT, _TEXT)),
        *[StructField(n, _LIST) for n in _LISTS],
        *[StructField(n, _TEXT) for n in _SCALARS],
    ]
)

EDGE = "child long, parent long"
