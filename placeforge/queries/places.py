"""Queries of placement, space, text, names, collisions, assembly, sinks and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge import constants as K
from placeforge.functions import columns, naming, text
from placeforge.operators import assemble, collisions, gates, placement, spatial, tiers
from placeforge.queries.graphs import supplier_codes
from placeforge.queries.views import POINTS_SQL, ROWS_SQL, points, position, rows, table
from placeforge.sources.writers import fingerprint_column, row_json


def iso(c):
    """Two letters for a small number."""
    return F.concat(F.lit("N"), F.chr(c.cast("long") + 65))


# --- placement ---------------------------------------------------------------------------------------------


def placement_inputs(spark, sf_dir):
    """Customers as settlements; nations as divisions or as whole countries; one in five has no statement."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    k, nat = F.col("c_custkey"), F.col("c_nationkey").cast("long")
    settlements = c.select(k.alias("id"), (nat % 5 + 900_000).alias("home"), F.array(F.concat(F.lit("Q"), (k + 1).cast("string"))).alias("same_as"))
    assign = c.filter("c_custkey % 5 <> 0").select(k.alias("qid"), F.when(k % 7 == 0, nat % 5 + 900_000).otherwise(nat + 100).alias("division"))
    rescue = c.filter("c_custkey % 3 = 0").select(k.alias("qid"), ((nat + F.when(k % 2 == 0, 0).otherwise(1)) % 25 + 100).alias("division"))
    plan = spark.range(5).select(iso(F.col("id")).alias("iso2"), (F.col("id") + 900_000).alias("country_qid"), F.when(F.col("id") == 4, "country").otherwise("admin1").alias("mode"))
    nk = F.col("n_nationkey").cast("long")
    divisions = n.filter("n_nationkey % 5 <> 4").select(iso(nk % 5).alias("iso2"), (nk + 100).alias("qid"), F.concat(iso(nk % 5), F.lit("-"), nk.cast("string")).alias("code"))
    hits = c.filter("c_custkey % 11 < 4").select(k.alias("id"), F.concat(iso(nat % 5), F.lit("-"), nat.cast("string")).alias("code"))
    return settlements, assign, rescue, plan, divisions, hits


def c1_placement(spark, sf_dir):
    return placement.place(*placement_inputs(spark, sf_dir)).select("id", "iso2", F.col("division").cast("string").alias("division"), "provenance", "held", "orphan")


_C1 = """c AS (SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS nat, CAST(c_nationkey % 5 AS BIGINT) AS h FROM customer),
a AS (SELECT *, CASE WHEN id % 5 = 0 THEN NULL WHEN id % 7 = 0 THEN h + 900000 ELSE nat + 100 END AS d,
  CASE WHEN id % 3 = 0 THEN (nat + CASE WHEN id % 2 = 0 THEN 0 ELSE 1 END) % 25 ELSE NULL END AS r, id % 11 < 4 AS hit FROM c),
b AS (SELECT *, d >= 900000 AND h <> 4 AS level, CASE WHEN d BETWEEN 100 AND 899999 AND h <> 4 THEN h WHEN d >= 900000 THEN h END AS own,
  CASE WHEN r % 5 <> 4 THEN r END AS br FROM a),
o AS (SELECT *, d IS NULL OR coalesce(level, FALSE) AS open, h AS home FROM b),
p AS (SELECT *, CASE WHEN open AND br IS NOT NULL AND br % 5 = home THEN 'contains' WHEN open AND hit AND h <> 4 THEN 'boundary' WHEN NOT open THEN 'stated' ELSE 'none' END AS provenance FROM o),
placed AS (SELECT id, 'N' || chr(CAST(h AS INTEGER) + 65) AS iso2, CAST(CASE provenance WHEN 'contains' THEN br + 100 WHEN 'boundary' THEN nat + 100 ELSE d END AS VARCHAR) AS division, provenance,
  provenance <> 'none' AS held, (CASE WHEN provenance IN ('contains', 'boundary') THEN h ELSE own END IS NULL AND h <> 4) AS orphan FROM p)"""
C1 = f"WITH {_C1} SELECT * FROM placed"


def a1_placement_counts(spark, sf_dir):
    return placement.placement_counts(placement.place(*placement_inputs(spark, sf_dir)))


A1 = f"""WITH {_C1} SELECT iso2, count(*) AS seen, count(*) FILTER (orphan) AS orphans, count(*) FILTER (NOT held) AS unheld,
count(*) FILTER (provenance = 'contains') AS by_contains, count(*) FILTER (provenance = 'boundary') AS by_boundary FROM placed GROUP BY iso2"""


def c2_same_as(spark, sf_dir):
    """Odd orders say they are the same as the next ones; those ending in a place (even keys) count."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ref = lambda c: F.concat(F.lit("Q"), c.cast("string"))
    cand = o.filter("o_orderkey % 3 = 1").select(k.alias("id"), F.array(ref(k + 1), F.lit("x"), ref(k + 2), ref(k + 3)).alias("same_as"))
    return placement.duplicates(cand, o.filter("o_orderkey % 2 = 0").select(k.alias("id")))


C2 = """WITH c AS (SELECT o_orderkey AS id, unnest([o_orderkey + 1, o_orderkey + 2, o_orderkey + 3]) AS t, unnest([0, 2, 3]) AS pos FROM orders WHERE o_orderkey % 3 = 1)
SELECT c.id, arg_min(t, pos) AS duplicate_of FROM c JOIN orders ON o_orderkey = t AND o_orderkey % 2 = 0 GROUP BY c.id"""


def vote_samples(spark, sf_dir) -> DataFrame:
    """Customers vote that their segment and nation group mean a region; one in twenty is off."""
    c = table(spark, sf_dir, "customer")
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("long")
    division = F.when((k % 20 == 0) | ((n == 3) & (k % 3 == 0)), 99).otherwise(n % 4).cast("long")
    return c.select(F.col("c_mktsegment").alias("iso2"), k.alias("id"), F.concat(F.lit("C-"), n.cast("string")).alias("code"), division.alias("division"))


def a3_code_vote(spark, sf_dir):
    return placement.vote(vote_samples(spark, sf_dir))


_VOTES = """s AS (SELECT c_mktsegment AS iso2, c_custkey AS id, 'C-' || c_nationkey AS code,
  CAST(CASE WHEN c_custkey % 20 = 0 OR (c_nationkey = 3 AND c_custkey % 3 = 0) THEN 99 ELSE c_nationkey % 4 END AS BIGINT) AS division FROM customer),
v AS (SELECT iso2, code, division, count(*) AS n, sum(count(*)) OVER (PARTITION BY iso2, code) AS total,
  row_number() OVER (PARTITION BY iso2, code ORDER BY count(*) DESC, division) AS rn FROM s GROUP BY iso2, code, division)"""
A3 = f"WITH {_VOTES} SELECT iso2, code, division FROM v WHERE rn = 1 AND total >= 5 AND n >= 0.9 * total"


def a4_interior_vote(spark, sf_dir):
    """Codes that failed are asked again with the rows whose key isn't a multiple of 3 or 20."""
    s = vote_samples(spark, sf_dir)
    return placement.vote(s, s.filter("id % 3 <> 0 and id % 20 <> 0"))


A4 = f"""WITH {_VOTES}, f AS (SELECT iso2, code FROM v WHERE rn = 1 AND total >= 5 AND n < 0.9 * total),
i AS (SELECT iso2, code, division, count(*) AS n, sum(count(*)) OVER (PARTITION BY iso2, code) AS total,
  row_number() OVER (PARTITION BY iso2, code ORDER BY count(*) DESC, division) AS rn FROM s SEMI JOIN f USING (iso2, code) WHERE id % 3 <> 0 AND id % 20 <> 0 GROUP BY iso2, code, division)
SELECT iso2, code, division FROM v WHERE rn = 1 AND total >= 5 AND n >= 0.9 * total
UNION ALL SELECT iso2, code, division FROM i WHERE rn = 1 AND total >= 5 AND n >= 0.9 * total"""


def c3_translate(spark, sf_dir):
    s = vote_samples(spark, sf_dir)
    return placement.translate(s.filter("id % 2 = 0").select("iso2", "id", "code"), placement.vote(s.filter("id % 2 = 1")))


C3 = f"""WITH {_VOTES.replace('FROM s GROUP', 'FROM s WHERE id % 2 = 1 GROUP')}
SELECT s.id, v.division FROM s JOIN v USING (iso2, code) WHERE s.id % 2 = 0 AND rn = 1 AND total >= 5 AND n >= 0.9 * total"""


# --- space -------------------------------------------------------------------------------------------------


def boxes(spark) -> DataFrame:
    """A 5 x 5 grid of overlapping rectangles with a hole in each: 36.5 by 18.5 degrees."""
    west, south = F.col("id") % 5 * 36 - 90, F.floor(F.col("id") / 5) * 18 - 45
    b = spark.range(25).select(F.col("id").cast("int").alias("slot"), west.cast("double").alias("west"), south.cast("double").alias("south"))
    b = b.withColumn("east", F.col("west") + 36.5).withColumn("north", F.col("south") + 18.5)
    ring = lambda w, s, e, n, hole: F.struct(F.lit(hole).alias("hole"), F.array(w, w, e, e, w).alias("xs"), F.array(s, n, n, s, s).alias("ys"))
    w, s, e, n = (F.col(c) for c in ("west", "south", "east", "north"))
    return b.withColumn("code", F.concat(F.lit("B-"), F.col("slot").cast("string"))).withColumn("rings", F.array(ring(w, s, e, n, False), ring(w + 10, s + 5, w + 12, s + 7, True)))


def j9_point_in_box(spark, sf_dir):
    return spatial.locate(points(spark, sf_dir), boxes(spark))


_BOX = """b AS (SELECT CAST(i AS INTEGER) AS slot, i % 5 * 36.0::DOUBLE - 90 AS w, (i // 5) * 18.0::DOUBLE - 45 AS s FROM range(25) t(i)),
h AS (SELECT id, slot, p.lat, p.lng FROM points p JOIN b ON lng >= w AND lng < w + 36.5 AND lat >= s AND lat < s + 18.5
  WHERE NOT (lng >= w + 10 AND lng < w + 12 AND lat >= s + 5 AND lat < s + 7))"""
J9 = f"WITH {POINTS_SQL}, {_BOX} SELECT id, 'B-' || min(slot) AS code FROM h GROUP BY id"


def j9_grid_cells(spark, sf_dir):
    cells = spatial.with_cells(boxes(spark)).groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"))
    p = points(spark, sf_dir).select("id", columns.cell(F.col("lng")).alias("cx"), columns.cell(F.col("lat")).alias("cy"))
    return p.join(cells, ["cx", "cy"]).select("id", "cx", "cy", "n")


J9G = f"""WITH {POINTS_SQL}, {_BOX.split(', h AS')[0].split(',' + chr(10) + 'h AS')[0]}, p AS (SELECT id, CAST(floor(lng) AS INTEGER) AS cx, CAST(floor(lat) AS INTEGER) AS cy FROM points)
SELECT id, cx, cy, count(*) AS n FROM p JOIN b ON cx BETWEEN floor(w) AND floor(w + 36.5) AND cy BETWEEN floor(s) AND floor(s + 18.5) GROUP BY id, cx, cy"""


def a4_well_inside(spark, sf_dir):
    p = points(spark, sf_dir)
    at = spatial.locate(p, boxes(spark))
    return spatial.well_inside(p.join(at, "id"), boxes(spark), 1.05).select("id", "code")


A4W = f"""WITH {POINTS_SQL.replace('points AS', 'points0 AS')}, d(k, a, o) AS (VALUES (0, 0.0::DOUBLE, 0.0::DOUBLE), (1, 1.05, 0.0), (2, -1.05, 0.0), (3, 0.0, 1.05), (4, 0.0, -1.05)),
points AS (SELECT id * 5 + k AS id, lat + a AS lat, lng + o AS lng FROM points0, d), {_BOX}, c AS (SELECT id, min(slot) AS slot FROM h GROUP BY id)
SELECT id // 5 AS id, 'B-' || min(slot) AS code FROM c GROUP BY id // 5 HAVING count(*) = 5 AND min(slot) = max(slot)"""


def _pairs(spark, sf_dir):
    p = points(spark, sf_dir)
    q = p.select((F.col("id") - 1).alias("id"), F.col("lat").alias("lat2"), F.col("lng").alias("lng2"))
    return p.join(q, "id")


def x13_distance(spark, sf_dir):
    km = columns.distance_km(F.col("lat"), F.col("lng"), F.col("lat2"), F.col("lng2"))
    return _pairs(spark, sf_dir).select("id", F.round(km * 1000).cast("long").alias("metres"))


_PAIR = f"{POINTS_SQL}, pair AS (SELECT a.id, a.lat, a.lng, b.lat AS lat2, b.lng AS lng2 FROM points a JOIN points b ON b.id = a.id + 1)"
X13 = f"""WITH {_PAIR} SELECT id, CAST(round(2 * 6371.0 * asin(sqrt(power(sin((radians(lat2) - radians(lat)) / 2), 2)
+ cos(radians(lat)) * cos(radians(lat2)) * power(sin((radians(lng2) - radians(lng)) / 2), 2))) * 1000) AS BIGINT) AS metres FROM pair"""


def x14_sector(spark, sf_dir):
    return _pairs(spark, sf_dir).select("id", columns.sector(F.col("lat2"), F.col("lng2"), F.col("lat") + 0.013, F.col("lng") + 0.017).alias("sector"))


X14 = f"""WITH {_PAIR}, t AS (SELECT id, degrees(atan2(sin(radians(lng2 - (lng + 0.017))) * cos(radians(lat2)),
  cos(radians(lat + 0.013)) * sin(radians(lat2)) - sin(radians(lat + 0.013)) * cos(radians(lat2)) * cos(radians(lng2 - (lng + 0.017))))) AS d FROM pair)
SELECT id, ['north', 'northeast', 'east', 'southeast', 'south', 'southwest', 'west', 'northwest'][CAST(floor((((d + 360) % 360) + 22.5) / 45) AS INTEGER) % 8 + 1] AS sector FROM t"""


def j14_close_pairs(spark, sf_dir):
    p = points(spark, sf_dir).select("id", F.col("nation").alias("region"), F.lit("x").alias("slug"), "lat", "lng")
    return collisions.close_pairs(p, 150.0)


J14 = f"""WITH {POINTS_SQL} SELECT a.id AS a, b.id AS b FROM points a JOIN points b ON a.nation = b.nation AND a.id < b.id
WHERE 2 * 6371.0 * asin(sqrt(power(sin((radians(b.lat) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * power(sin((radians(b.lng) - radians(a.lng)) / 2), 2))) <= 150"""


# --- values ------------------------------------------------------------------------------------------------


def f12_point_parse(spark, sf_dir):
    p = points(spark, sf_dir)
    wkt = F.when(F.col("id") % 7 == 0, F.concat(F.lit("Point("), F.col("lng").cast("string"), F.lit(")"))).when(F.col("id") % 7 == 1, "Point(1.2.3 4)").otherwise(
        F.concat(F.when(F.col("id") % 2 == 0, "POINT(").otherwise("Point("), (F.col("id") * 3).cast("string"), F.lit("  -"), F.col("id").cast("string"), F.lit(".5)"))
    )
    lat, lng = columns.parse_point(wkt)
    return p.select("id", lat.alias("lat"), lng.alias("lng"))


F12 = "SELECT c_custkey AS id, CASE WHEN c_custkey % 7 > 1 THEN -(c_custkey + 0.5::DOUBLE) END AS lat, CASE WHEN c_custkey % 7 > 1 THEN CAST(c_custkey * 3 AS DOUBLE) END AS lng FROM customer"


def f13_number_parse(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    v = F.element_at(F.array(F.concat(F.lit("+"), k.cast("string")), F.concat(k.cast("string"), F.lit(".9")), F.lit("x1"), F.lit(""), F.concat(F.lit("-"), k.cast("string"), F.lit("e2"))), (k % 5).cast("int") + 1)
    return c.select(k.alias("id"), columns.parse_int(v).cast("string").alias("whole"), columns.parse_float(v).alias("real"))


F13 = """SELECT c_custkey AS id, CAST(CASE c_custkey % 5 WHEN 0 THEN c_custkey WHEN 1 THEN c_custkey WHEN 4 THEN -c_custkey * 100 END AS VARCHAR) AS whole,
CAST(CASE c_custkey % 5 WHEN 0 THEN c_custkey WHEN 1 THEN c_custkey + 0.9::DOUBLE WHEN 4 THEN -c_custkey * 100 END AS DOUBLE) AS real FROM customer"""


def f14_references(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    lst = F.array(F.when(k % 2 == 0, "plain").otherwise(F.lit(None)), F.when(k % 3 == 0, F.concat(F.lit("Q"), k.cast("string"))), F.lit("Q7"))
    return c.select(k.alias("id"), columns.first_reference(lst).alias("first"), columns.reference(lst[1]).alias("second"))


F14 = "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_custkey ELSE 7 END AS first, CASE WHEN c_custkey % 3 = 0 THEN 'Q' || c_custkey END AS second FROM customer"


def f5_prefix_codes(spark, sf_dir):
    s = supplier_codes(spark, sf_dir)
    return s.select("id", F.array_join(columns.with_prefix(F.col("iso_3166_2"), F.col("own")), ",").alias("codes"))


F5P = """SELECT s_suppkey AS id, 'N' || chr(CAST(s_nationkey AS INTEGER) + 65) || '-' || (s_suppkey % 7) || ',' || 'N' || chr(CAST(s_nationkey AS INTEGER) + 65) || '-' || (s_suppkey % 3) AS codes FROM supplier"""


def x1_fold(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.fold_column(F.col("text")).alias("folded"))


_FOLD = "strip_accents(replace(replace(replace(replace(text, 'ß', 'ss'), 'ø', 'o'), 'Ø', 'O'), 'œ', 'oe'))"
X1 = f"SELECT doc_id, {_FOLD} AS folded FROM documents"


def x2_slug(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.slug_column(F.col("text")).alias("slug"))


X2 = rf"""SELECT doc_id, regexp_replace(regexp_replace(lower(regexp_replace({_FOLD}, '[^A-Za-z0-9_\s-]', '', 'g')), '^\s+|\s+$', '', 'g'), '[-\s]+', '-', 'g') AS slug FROM documents"""


def x3_coord(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    v = F.when(F.col("l_linenumber") == 1, F.lit(-0.0000005)).when(F.col("l_linenumber") == 2, F.lit(0.1234565)).otherwise((F.col("l_extendedprice") - 500) / F.nullif(F.col("l_partkey").cast("double"), F.lit(0.0)) / 7)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", text.fixed_column(v).alias("fixed"))


X3 = """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 1 THEN printf('%.6f', -0.0000005::DOUBLE) WHEN l_linenumber = 2 THEN printf('%.6f', 0.1234565::DOUBLE)
WHEN l_partkey = 0 THEN NULL ELSE printf('%.6f', (l_extendedprice - 500) / l_partkey::DOUBLE / 7) END AS fixed FROM lineitem"""


def x4_flag(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.select("n_nationkey", columns.flag(F.lower(iso(F.col("n_nationkey")))).alias("flag"), columns.country_tld(F.when(F.col("n_nationkey") == 0, "GB").otherwise(iso(F.col("n_nationkey")))).alias("tld"))


X4 = """SELECT n_nationkey, chr(127462 + 13) || chr(127462 + CAST(n_nationkey AS INTEGER)) AS flag,
CASE WHEN n_nationkey = 0 THEN '.uk' ELSE '.n' || lower(chr(CAST(n_nationkey AS INTEGER) + 65)) END AS tld FROM nation"""


def x6_script(spark, sf_dir):
    """The script of each document's first letter: Latin or another."""
    d = table(spark, sf_dir, "documents")
    own = text.script_column(F.col("text"))
    return d.select("doc_id", F.when(own == "LATIN", own).otherwise(F.when(own.isNotNull(), "OTHER")).alias("script"))


X6 = r"SELECT doc_id, CASE WHEN regexp_extract(text, '(\p{L})', 1) = '' THEN NULL WHEN regexp_matches(regexp_extract(text, '(\p{L})', 1), '\p{Latin}') THEN 'LATIN' ELSE 'OTHER' END AS script FROM documents"


# --- names -------------------------------------------------------------------------------------------------


def x8_resolve_name(spark, sf_dir):
    """Parts as entities with labels in up to three languages, some with a bracket; French is the language of half of them."""
    p, size = table(spark, sf_dir, "part"), F.col("p_size")
    said = F.create_map(
        F.lit("de"), F.when(size % 5 == 0, F.concat("p_type", F.lit(" (x)"))).otherwise(F.col("p_type")),
        F.lit("en"), F.when(size % 3 != 0, F.col("p_name")), F.lit("fr"), F.when(size % 4 != 0, F.col("p_brand")),
    )
    g = p.select("p_partkey", F.map_filter(said, lambda _k, v: v.isNotNull()).alias("labels"), F.when(size % 2 == 0, "fr").alias("native"))
    return g.select("p_partkey", naming.resolve_column(F.col("labels"), F.col("native")).alias("n")).select("p_partkey", F.col("n.name").alias("name"), F.col("n.lang").alias("lang"))


X8 = """SELECT p_partkey, CASE lang WHEN 'en' THEN p_name WHEN 'fr' THEN p_brand ELSE p_type || CASE WHEN p_size % 5 = 0 THEN ' (x)' ELSE '' END END AS name, lang FROM (
SELECT *, CASE WHEN p_size % 3 <> 0 THEN 'en' WHEN p_size % 2 = 0 AND p_size % 4 <> 0 THEN 'fr' WHEN p_size % 5 <> 0 THEN 'de' WHEN p_size % 4 <> 0 THEN 'fr' ELSE 'de' END AS lang FROM part)"""


def x9_strip_qualifier(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    label = F.when(F.col("p_size") % 3 == 0, F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")"))).when(F.col("p_size") % 3 == 1, F.concat(F.col("p_name"), F.lit(" ["), F.col("p_type"), F.lit("]"))).otherwise(F.col("p_name"))
    return p.select("p_partkey", naming.qualifier_column(label).alias("q")).select("p_partkey", F.col("q.head").alias("head"), F.col("q.qualifier").alias("qualifier"))


X9 = "SELECT p_partkey, p_name AS head, CASE p_size % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_type END AS qualifier FROM part"


def x11_strip_address(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    label = F.when(F.col("p_size") % 2 == 0, F.concat(F.col("p_name"), F.lit(", Some Rayon, "), F.col("p_brand"))).when(F.col("p_size") % 4 == 1, F.concat(F.col("p_name"), F.lit(", Rayon"))).otherwise(F.concat(F.col("p_name"), F.lit(", a, b")))
    return p.select("p_partkey", naming.address_column(label).alias("name"))


X11 = "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name WHEN p_size % 4 = 1 THEN p_name || ', Rayon' ELSE p_name || ', a, b' END AS name FROM part"


def x12_alt_names(spark, sf_dir):
    """Brands as entities, the names and types of their parts as aliases in three languages."""
    p, size = table(spark, sf_dir, "part"), F.col("p_size")
    sets = [F.collect_set(F.when(size % n == 0, F.col(c))).alias(lang) for lang, n, c in (("en", 2, "p_name"), ("de", 3, "p_type"), ("fr", 5, "p_name"))]
    m = p.groupBy("p_brand").agg(*sets).select("p_brand", F.create_map(*[x for lang in ("de", "en", "fr") for x in (F.lit(lang), F.col(lang))]).alias("alts"))
    own = naming.alt_names_column(F.col("alts"), F.lit("de"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    return m.withColumn("own", own).select("p_brand", F.array_join(F.try_element_at("own", F.lit("en")), ",").alias("en"), F.array_join(F.try_element_at("own", F.lit("de")), ",").alias("de"), F.size("own").alias("langs"))


X12 = """WITH v AS (SELECT p_brand, string_agg(DISTINCT p_name, ',' ORDER BY p_name) FILTER (p_size % 2 = 0) AS en,
string_agg(DISTINCT p_type, ',' ORDER BY p_type) FILTER (p_size % 3 = 0) AS de FROM part GROUP BY p_brand)
SELECT p_brand, en, de, CAST((en IS NOT NULL)::INTEGER + (de IS NOT NULL)::INTEGER AS INTEGER) AS langs FROM v"""


def x19_country_name(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    code = F.when(F.col("n_nationkey") == 1, "HR").when(F.col("n_nationkey") == 2, "CI").otherwise(iso(F.col("n_nationkey")))
    e = n.select(code.alias("iso2"), F.when(F.col("n_nationkey") % 5 != 4, F.create_map(F.lit("en"), F.col("n_name"))).alias("labels"), F.lit(None).cast("string").alias("native"))
    return assemble.country_names(e).select("iso2", "country_name")


X19 = """SELECT CASE n_nationkey WHEN 1 THEN 'HR' WHEN 2 THEN 'CI' ELSE 'N' || chr(CAST(n_nationkey AS INTEGER) + 65) END AS iso2,
CASE WHEN n_nationkey = 1 THEN 'Croatia' WHEN n_nationkey = 2 THEN 'Ivory Coast' WHEN n_nationkey = 11 THEN 'Netherlands' WHEN n_nationkey % 5 <> 4 THEN n_name ELSE 'N' || chr(CAST(n_nationkey AS INTEGER) + 65) END AS country_name FROM nation"""


def x20_admin1_source(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    nat = F.col("c_nationkey").cast("long")
    src = placement.admin1_source(nat, F.lit(7).cast("long"), F.when(F.col("c_custkey") % 2 == 0, "country").otherwise("admin1"), F.col("c_custkey") % 3 == 0)
    return c.select(F.col("c_custkey").alias("id"), src.alias("source"))


X20 = "SELECT c_custkey AS id, CASE WHEN c_nationkey = 7 AND c_custkey % 2 <> 0 THEN 'none' WHEN c_custkey % 3 = 0 THEN 'boundary' ELSE 'stated' END AS source FROM customer"


# --- collisions --------------------------------------------------------------------------------------------


def w1_plain_holder(spark, sf_dir):
    return collisions.sweep(rows(spark, sf_dir)).select("admin1_id", "slug", "id")


W1 = f"""WITH {ROWS_SQL} SELECT admin1_id, slug, id FROM (SELECT *, row_number() OVER (PARTITION BY admin1_id, slug
ORDER BY CASE WHEN coalesce(population, 0) = 0 THEN -1 ELSE population END DESC, id) AS rn FROM places) WHERE rn = 1"""


def w3_first_by_id(spark, sf_dir):
    """One row for each id where a table repeats them."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return assemble.first_of(li, "l_orderkey", "l_linenumber", "l_partkey")


W3 = "SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS rn FROM lineitem) WHERE rn = 1"


def c4_collisions(spark, sf_dir):
    """Pairs of far-apart rows with one name: the larger keeps it, the other is told apart by its parent."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    pair = F.floor(k / 2)
    text0 = lambda t: F.lit(None).cast(t)
    r = c.select(
        k.alias("id"), F.lit("s").alias("source"), F.col("c_nationkey").cast("long").alias("x"), F.lit(1).cast("long").alias("admin1_id"), F.lit("stated").alias("admin1_source"),
        F.lit("XX").alias("country_code"), F.concat(F.lit("Place "), pair.cast("string")).alias("name"), F.lit("en").alias("name_lang"),
        F.concat(F.lit("place-"), pair.cast("string")).alias("slug"), (k % 2 * 10).cast("string").alias("latitude"), F.lit("0").alias("longitude"),
        F.floor("c_acctbal").cast("long").alias("population"), F.lit("Q5").alias("admin2_id"), F.lit(K.SOURCE).alias("z"),
        F.concat(F.lit("parent "), k.cast("string")).alias("parent_label"), text0("string").alias("upstream_qualifier"),
    ).drop("x", "z")
    return collisions.resolve_collisions(r).select("id", "name", "slug")


C4 = """WITH p AS (SELECT c_custkey AS id, c_custkey // 2 AS g, CAST(floor(c_acctbal) AS BIGINT) AS pop FROM customer),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY CASE WHEN pop = 0 THEN -1 ELSE pop END DESC, id) AS rn FROM p)
SELECT id, CASE WHEN rn = 1 THEN 'Place ' || g ELSE 'Place ' || g || ' (parent ' || id || ')' END AS name,
CASE WHEN rn = 1 THEN 'place-' || g ELSE 'place-' || g || '-parent-' || id END AS slug FROM r"""


def a5_absorb(spark, sf_dir):
    """Lines of one order as one; of lines equal in `pos` the first of the table counts, as in its SQL on one thread."""
    li = table(spark, sf_dir, "lineitem")
    r = li.select("l_orderkey", (F.col("l_linenumber").cast("long") * 1_000_000_000 + F.col("l_partkey")).alias("pos"), F.when(F.col("l_partkey") % 3 == 0, F.col("l_partkey").cast("string")).alias("part"), F.when(F.col("l_suppkey") % 2 == 0, "").otherwise(F.col("l_suppkey").cast("string")).alias("supp"), position(li).alias("at"))
    return collisions.absorb_groups(r, "l_orderkey", "pos", ["part", "supp"], ties=("at",))


A5 = """WITH r AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey AS pos, CASE WHEN l_partkey % 3 = 0 THEN CAST(l_partkey AS VARCHAR) END AS part, CASE WHEN l_suppkey % 2 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS supp FROM lineitem)
SELECT l_orderkey, min(pos) AS pos, arg_min(part, pos) FILTER (part IS NOT NULL) AS part, arg_min(supp, pos) FILTER (supp IS NOT NULL) AS supp FROM r GROUP BY l_orderkey"""


def a11_name_frequency(spark, sf_dir):
    r = rows(spark, sf_dir).withColumn("parent_label", F.concat(F.lit("p"), (F.col("id") % 3).cast("string")))
    return r.select("id", collisions.label_frequency("parent_label").alias("n"))


A11 = f"WITH {ROWS_SQL} SELECT id, count(*) OVER (PARTITION BY admin1_id, slug, id % 3) AS n FROM places"


def a6_mean_coord(spark, sf_dir):
    """Means of whole-degree points, where the order of the sum can't matter."""
    p = points(spark, sf_dir)
    s = p.select(F.col("nation").alias("admin1_id"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"), "id", text.fixed_column(F.floor("lat")).alias("latitude"), text.fixed_column(F.floor("lng")).alias("longitude"))
    return assemble.mean_coordinates(s, s.select("admin1_id").distinct())


A6 = f"""WITH {POINTS_SQL} SELECT nation AS admin1_id, printf('%.6f', sum(floor(lat)) / count(*)) AS latitude, printf('%.6f', sum(floor(lng)) / count(*)) AS longitude FROM points GROUP BY nation"""


def x21_sole(spark, sf_dir):
    """Whether a nation that stands for its region is the only one of it."""
    n = table(spark, sf_dir, "nation")
    sole, unassigned = assemble.sole_flags(F.col("n_nationkey") % 5 == 0, "n_regionkey")
    return n.select("n_nationkey", sole.alias("sole"), unassigned.alias("unassigned"))


X21 = "SELECT n_nationkey, (n_nationkey % 5 = 0 AND c = 1) AS sole, (n_nationkey % 5 = 0 AND c > 1) AS unassigned FROM (SELECT *, count(*) OVER (PARTITION BY n_regionkey) AS c FROM nation)"


# --- assembly, sinks, gates --------------------------------------------------------------------------------


def x17_extra_fields(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    none = lambda t: F.lit(None).cast(t)
    e = c.select(
        k.alias("id"), F.concat(F.lit("+"), k.cast("string")).alias("population"), F.array(F.concat(F.lit("Q"), k.cast("string"))).alias("instance_of"), F.lit("").alias("geonames_id"),
        F.when(k % 2 == 0, "Q9").otherwise("zone").alias("timezone"), F.lit("").alias("postal_code"), (k / 8).cast("string").alias("elevation"), F.array(F.lit("b"), F.lit("a")).alias("native_label"),
        none("map<string,array<string>>").alias("alt_labels"), none("string").alias("area"), none("string").alias("osm_relation_id"), F.lit("Q1").alias("capital_of"), none("array<string>").alias("located_in"),
    )
    return e.select("id", *assemble.extra_fields(F.lit("de"), F.lit("Z"), none("string"), none("string"))).select(
        "id", "population", "place_type", "geonames_id", "timezone", "postal_code", "elevation", F.array_join("native_label", ",").alias("native_label"), "capital_of", "admin2_id", "timezone_id"
    )


X17 = """SELECT c_custkey AS id, CAST(c_custkey AS BIGINT) AS population, 'Q' || c_custkey AS place_type, CAST(NULL AS BIGINT) AS geonames_id, CASE WHEN c_custkey % 2 = 0 THEN 'Q9' END AS timezone,
CAST(NULL AS VARCHAR) AS postal_code, c_custkey / 8.0::DOUBLE AS elevation, 'a,b' AS native_label, 'Q1' AS capital_of, CAST(NULL AS VARCHAR) AS admin2_id, 'Z' AS timezone_id FROM customer"""


def j4_official_language(spark, sf_dir):
    """Nations whose languages are suppliers: the least code."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    lang = s.select((F.col("s_suppkey") + 1000).alias("id"), F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit("l"), (F.col("s_suppkey") % 10).cast("string"))).alias("wm_lang_code"), F.lit(None).cast("array<string>").alias("official_language"))
    own = s.groupBy("s_nationkey").agg(F.collect_list(F.concat(F.lit("Q"), (F.col("s_suppkey") + 1000).cast("string"))).alias("official_language"))
    own = own.select(F.col("s_nationkey").cast("long").alias("id"), F.lit(None).cast("string").alias("wm_lang_code"), "official_language")
    plan = n.select(iso(F.col("n_nationkey")).alias("iso2"), F.col("n_nationkey").cast("long").alias("country_qid"))
    return assemble.official_languages(lang.union(own), plan)


J4 = "SELECT 'N' || chr(CAST(s_nationkey AS INTEGER) + 65) AS iso2, min('l' || (s_suppkey % 10)) AS native FROM supplier WHERE s_suppkey % 3 <> 0 GROUP BY s_nationkey"


def k1_ndjson_lines(spark, sf_dir):
    """Rows as compact JSON: nulls kept, numbers as the format wants them, keys in order."""
    n = table(spark, sf_dir, "nation")
    r = n.select(F.col("n_nationkey").cast("long").alias("id"), "n_name", (F.col("n_nationkey") * 2.5e6).alias("area"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_regionkey").cast("long")).alias("up"))
    return r.select("id", row_json(r, ("id", "n_name", "area", "up")).alias("line"))


K1 = """SELECT CAST(n_nationkey AS BIGINT) AS id, '{"id":' || n_nationkey || ',"n_name":"' || n_name || '","area":' || CAST(n_nationkey * 2500000 AS BIGINT) || '.0,"up":' ||
CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_regionkey AS VARCHAR) ELSE 'null' END || '}' AS line FROM nation"""


def k4_fingerprint(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    lines = n.select("n_nationkey", F.concat(F.col("n_name"), F.lit(":"), F.sha2(F.col("n_name"), 256)).alias("line"))
    return fingerprint_column(lines, "n_nationkey", "line")


K4 = "SELECT substr(sha256(string_agg(n_name || ':' || sha256(n_name), chr(10) ORDER BY n_nationkey)), 1, 16) AS fingerprint FROM nation"


def order_manifests(spark, sf_dir):
    """Orders by customer before and after a day as two manifests."""
    o = table(spark, sf_dir, "orders").withColumn("code", (F.col("o_custkey") % 200).cast("string"))
    of = lambda f: o.filter(f).groupBy("code").agg(F.count(F.lit(1)).alias("settlements"))
    return of("o_orderdate < '1998-04-01' and o_custkey % 7 <> 0"), of("o_orderdate >= '1998-04-01' and o_custkey % 11 <> 0")


_MAN = """a AS (SELECT CAST(o_custkey % 200 AS VARCHAR) AS code, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-04-01' AND o_custkey % 7 <> 0 GROUP BY 1),
b AS (SELECT CAST(o_custkey % 200 AS VARCHAR) AS code, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1998-04-01' AND o_custkey % 11 <> 0 GROUP BY 1)"""


def j15_baseline_diff(spark, sf_dir):
    return gates.compare(*order_manifests(spark, sf_dir)).select("code", "old", "new", F.round(F.col("ratio") * 1_000_000).cast("long").cast("string").alias("ppm"))


J15 = f"""WITH {_MAN} SELECT code, coalesce(a.n, 0) AS old, coalesce(b.n, 0) AS new, CASE WHEN a.n > 0 THEN CAST(CAST(round(coalesce(b.n, 0) / a.n::DOUBLE * 1000000) AS BIGINT) AS VARCHAR) END AS ppm
FROM a FULL JOIN b USING (code)"""


def w6_regression(spark, sf_dir):
    old, new = order_manifests(spark, sf_dir)
    allowed = spark.range(50).select(F.col("id").cast("string").alias("code"))
    return gates.regressions(old, new, allowed).select("code", "old", "new", "blocking")


W6 = f"""WITH {_MAN} SELECT code, a.n AS old, coalesce(b.n, 0) AS new, CAST(code AS INTEGER) >= 50 AS blocking FROM a LEFT JOIN b USING (code) WHERE coalesce(b.n, 0) / a.n::DOUBLE < 0.7"""


def gate_tables(spark, sf_dir):
    n, c = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    countries = n.select(F.col("n_nationkey").cast("string").alias("code"), F.when(F.col("n_nationkey") % 6 != 0, F.concat(F.lit("Customer "), (F.col("n_nationkey") * 3).cast("string"))).alias("capital_name"))
    s = c.select(F.col("c_nationkey").cast("string").alias("country_code"), F.concat(F.lit("customer-"), (F.col("c_custkey") % 90).cast("string")).alias("slug"), F.when(F.col("c_custkey") % 50 != 0, "1").alias("latitude"), F.lit("2").alias("longitude"))
    return countries, s


def j16_capital_presence(spark, sf_dir):
    return gates.capital_presence(*gate_tables(spark, sf_dir))


J16 = """SELECT CAST(n_nationkey AS VARCHAR) AS code, 'Customer ' || (n_nationkey * 3) AS capital_name,
EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_custkey % 90 = n_nationkey * 3) AS present FROM nation WHERE n_nationkey % 6 <> 0"""


def a7_coverage(spark, sf_dir):
    g = gates.coverage(gate_tables(spark, sf_dir)[1])
    return g.select("gate", F.round(F.col("value") * 1_000_000).cast("long").alias("ppm"), "threshold", "ok")


A7 = """SELECT 'coordinate coverage' AS gate, CAST(round(avg(CASE WHEN c_custkey % 50 <> 0 THEN 1.0 ELSE 0.0 END) * 1000000) AS BIGINT) AS ppm, 0.99::DOUBLE AS threshold,
avg(CASE WHEN c_custkey % 50 <> 0 THEN 1.0 ELSE 0.0 END) >= 0.99 AS ok FROM customer"""


def a9_distinct_slugs(spark, sf_dir):
    s = gate_tables(spark, sf_dir)[1]
    return s.groupBy("country_code").agg(F.count_distinct("slug").alias("slugs"))


A9 = "SELECT CAST(c_nationkey AS VARCHAR) AS country_code, count(DISTINCT c_custkey % 90) AS slugs FROM customer GROUP BY c_nationkey"


def c7_gates(spark, sf_dir):
    countries, s = gate_tables(spark, sf_dir)
    old, new = order_manifests(spark, sf_dir)
    return gates.run_gates(countries, s, new, old).select("gate", F.round(F.col("value") * 1_000_000).cast("long").alias("ppm"), "ok")


C7 = f"""WITH {_MAN}, v AS (
SELECT 'coordinate coverage' AS gate, avg(CASE WHEN c_custkey % 50 <> 0 THEN 1.0::DOUBLE ELSE 0.0 END) AS v, 0.99 AS t, 1 AS up FROM customer
UNION ALL SELECT 'capitals named', avg(CASE WHEN n_nationkey % 6 <> 0 THEN 1.0::DOUBLE ELSE 0.0 END), 0.8, 1 FROM nation
UNION ALL SELECT 'capitals missing', avg(CASE WHEN EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_custkey % 90 = n_nationkey * 3) THEN 0.0::DOUBLE ELSE 1.0 END), 0.05, 0 FROM nation WHERE n_nationkey % 6 <> 0
UNION ALL SELECT 'country loss', (SELECT count(*) FROM a ANTI JOIN b USING (code)) / (SELECT count(*) FROM a)::DOUBLE, 0.02, 0
UNION ALL SELECT 'settlement loss', ((SELECT sum(n) FROM a) - (SELECT sum(n) FROM b)) / (SELECT sum(n) FROM a)::DOUBLE, 0.1, 0
UNION ALL SELECT 'countries below ratio', (SELECT count(*) FROM a LEFT JOIN b USING (code) WHERE coalesce(b.n, 0) / a.n::DOUBLE < 0.7)::DOUBLE, 0, 0)
SELECT gate, CAST(round(v * 1000000) AS BIGINT) AS ppm, CASE WHEN up = 1 THEN v >= t ELSE v <= t END AS ok FROM v"""


def k9_snapshot_diff(spark, sf_dir):
    old, new = order_manifests(spark, sf_dir)
    with_sha = lambda d, m: d.withColumn("regions", F.lit(1)).withColumn("sha", (F.col("settlements") % m).cast("string"))
    return gates.snapshot_diff(with_sha(old, 2), with_sha(new, 3)).select("code", "change")


K9 = f"""WITH {_MAN}, c AS (SELECT code, a.n AS o, b.n AS w FROM a FULL JOIN b USING (code))
SELECT code, CASE WHEN w IS NULL THEN 'dropped' WHEN o IS NULL THEN 'added' WHEN o <> w THEN 'counts' ELSE 'bytes' END AS change FROM c WHERE o IS NULL OR w IS NULL OR o <> w OR o % 2 <> w % 3"""


def o3_union(spark, sf_dir):
    p, s = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    return p.select(F.col("p_partkey").alias("k")).union(s.select((F.col("s_suppkey") * 30).alias("k"))).distinct()


def o4_difference(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return c.select(F.col("c_custkey").alias("k")).join(o.select(F.col("o_custkey").alias("k")), "k", "left_anti")


def o5_intersection(spark, sf_dir):
    p, li = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    return p.select(F.col("p_partkey").alias("k")).join(li.select(F.col("l_suppkey").alias("k")), "k", "left_semi")


O3 = "SELECT p_partkey AS k FROM part UNION SELECT s_suppkey * 30 FROM supplier"
O4 = "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders"
O5 = "SELECT p_partkey AS k FROM part INTERSECT SELECT l_suppkey FROM lineitem"


def o2_top_regressions(spark, sf_dir):
    """A top-20 report: the countries that lost most."""
    return gates.compare(*order_manifests(spark, sf_dir)).withColumn("lost", F.col("old") - F.col("new")).orderBy(F.desc("lost"), "code").limit(20).select("code", "lost")


O2 = f"WITH {_MAN} SELECT code, coalesce(a.n, 0) - coalesce(b.n, 0) AS lost FROM a FULL JOIN b USING (code) ORDER BY lost DESC, code LIMIT 20"


def tier_seeds(spark, sf_dir):
    _, _, _, plan, divisions, _ = placement_inputs(spark, sf_dir)
    return tiers.seeds(plan, divisions)


SEEDS = """SELECT CAST(n_nationkey + 100 AS BIGINT) AS qid, CAST(0 AS INTEGER) AS depth, CAST(n_nationkey + 100 AS BIGINT) AS division FROM nation WHERE n_nationkey % 5 <> 4
UNION ALL SELECT CAST(900000 + i AS BIGINT), CAST(3 AS INTEGER), CAST(900000 + i AS BIGINT) FROM range(4) t(i)"""

_G = globals()
_NAMES = {
    "c1_placement": "C1", "a1_placement_counts": "A1", "c2_same_as": "C2", "a3_code_vote": "A3", "a4_interior_vote": "A4", "c3_translate": "C3",
    "j9_point_in_box": "J9", "j9_grid_cells": "J9G", "a4_well_inside": "A4W", "x13_distance": "X13", "x14_sector": "X14", "j14_close_pairs": "J14",
    "f12_point_parse": "F12", "f13_number_parse": "F13", "f14_references": "F14", "f5_prefix_codes": "F5P", "x1_fold": "X1", "x2_slug": "X2",
    "x3_coord": "X3", "x4_flag": "X4", "x6_script": "X6", "x8_resolve_name": "X8", "x9_strip_qualifier": "X9", "x11_strip_address": "X11",
    "x12_alt_names": "X12", "x17_extra_fields": "X17", "x19_country_name": "X19", "x20_admin1_source": "X20", "x21_sole": "X21",
    "w1_plain_holder": "W1", "w3_first_by_id": "W3", "c4_collisions": "C4", "a5_absorb": "A5", "a11_name_frequency": "A11", "a6_mean_coord": "A6",
    "j4_official_language": "J4", "k1_ndjson_lines": "K1", "k4_fingerprint": "K4", "k9_snapshot_diff": "K9", "j15_baseline_diff": "J15",
    "w6_regression": "W6", "j16_capital_presence": "J16", "a7_coverage": "A7", "a9_distinct_slugs": "A9", "c7_gates": "C7", "o2_top_regressions": "O2",
    "o3_union": "O3", "o4_difference": "O4", "o5_intersection": "O5", "t6_seeds": "SEEDS",
}
QUERIES = {name: (_G["tier_seeds" if name == "t6_seeds" else name], _G[sql]) for name, sql in _NAMES.items()}
