"""Identifiers, codes and thresholds that results depend on."""

# Class roots.
SETTLEMENT_ROOTS = (486972, 15284)
ADMIN_ROOT = 56061
ISO_ABOUT_CLASSES = (15087423, 17305522)
HARD_EXCLUDE_ROOTS = (
    44613, 130003, 79007, 1348006, 22969563, 17540983, 152081, 8343784, 1070290, 5996900, 628505, 4228434,
    66626342, 134524402, 2282602,
)
FORMER_ROOTS = (19953632, 22674925)
SOFT_EXCLUDE_ROOTS = (123705, 5327369)
CORE_CITY_ROOTS = (515, 3957, 532, 15284)
CLOSURE_BLOCKED = (15623456, 97095925)
NOT_A_PLACE_ROOTS = (473972, 12143)
NOT_A_PLACE_CLASSES = (
    192611, 15620943, 5508804, 2973947, 17166756, 28657263, 2713747, 20220333,
    3146899, 18917976, 20060955, 105390172, 124098638, 123696317, 1385389, 57413580, 7137411, 644930,
    1768043, 1907114, 2342385,
    398141, 2822246, 7603678,
    3497366, 34442, 676050, 15243209, 618123, 184358, 718570, 6063204,
)
SANDBOX_ENTITIES = (4115189, 13406268, 15397819)

# Hand-kept region exclusions.
REGION_EXCLUDE_CODES = (
    "GB-EAW", "GB-GBN", "ID-JW", "ID-KA", "ID-ML", "ID-NU", "ID-PP", "ID-SL", "ID-SM", "MA-MMD", "MA-MMN",
    *(f"LT-{n:02d}" for n in range(1, 61)),
)
REGION_EXCLUDE_CLASSES = (202595, 18524218, 194203)
REGION_EXCLUDE_QIDS = (209706,)

# Graph limits and depth offsets of seeds.
MAX_ROUNDS = 40
ANCESTOR_HOPS = 12
LEAF_OFFSET, COUNTRY_OFFSET = 0, 3

# Distances, boundary votes, name rules.
MERGE_KM = 2.0
EARTH_KM = 6371.0
MIN_SUPPORT, MIN_PURITY, EDGE_MARGIN, CELL = 5, 0.90, 0.05, 1.0
MIN_LETTERS_KEPT, MAX_NAME = 0.6, 100

# Spellings.
COUNTRY_NAME_OVERRIDES = {
    "CD": "Congo Republic", "HR": "Croatia", "CI": "Ivory Coast", "HK": "Hong Kong", "BS": "Bahamas",
    "NL": "Netherlands", "GM": "Gambia",
}
TLD_OVERRIDES = {"GB": ".uk"}

# Gate thresholds.
MAX_COUNTRY_LOSS, MAX_CITY_LOSS, MIN_COVERAGE = 0.02, 0.10, 0.99
MIN_CITY_RATIO, MAX_MISSING_CAPITALS, MIN_NAMED_CAPITALS = 0.70, 0.05, 0.80
MIN_SCAN_CAPITALS = 0.50

# Dump properties and what they become.
PROPERTIES = {
    "P31": "instance_of", "P279": "subclass_of", "P131": "located_in", "P150": "contains", "P460": "same_as",
    "P625": "coord", "P17": "country", "P300": "iso_3166_2", "P297": "iso_3166_1", "P1082": "population",
    "P1566": "geonames_id", "P421": "timezone", "P281": "postal_code", "P2044": "elevation",
    "P1705": "native_label", "P2046": "area", "P402": "osm_relation_id", "P1376": "capital_of",
    "P576": "dissolved", "P582": "end_time", "P37": "official_language", "P424": "wm_lang_code",
    "P36": "capital", "P30": "continent", "P38": "currency", "P78": "tld", "P298": "iso_3166_1_alpha3",
    "P299": "iso_3166_1_numeric", "P474": "calling_code", "P1549": "demonym", "P498": "currency_code",
    "P5061": "unit_symbol",
}
MULTI_FIELDS = (
    "instance_of", "subclass_of", "located_in", "contains", "same_as", "native_label", "official_language",
    "iso_3166_2", "iso_3166_1", "capital", "continent", "currency", "tld", "calling_code",
)
KEEP_IF = ("located_in", "coord", "subclass_of", "iso_3166_2", "iso_3166_1", "wm_lang_code", "currency_code")
PRESENCE_FIELDS = ("dissolved", "end_time")
SOURCE = "wikidata"

# What a manifest says of its data.
LICENSE = "CC0-1.0"
MANIFEST_SOURCE = "https://www.wikidata.org/ (Wikidata truthy dump, CC0)"

# Addresses in the dump.
ENTITY_IRI = "http://www.wikidata.org/entity/"
DIRECT_IRI = "http://www.wikidata.org/prop/direct/"
LABEL_IRI = "http://www.w3.org/2000/01/rdf-schema#label"
ALIAS_IRI = "http://www.w3.org/2004/02/skos/core#altLabel"
