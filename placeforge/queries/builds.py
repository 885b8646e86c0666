"""Queries of whole builds and of the steps between entities and rows, over a world made from the tables.

Regions are countries (codes RA, RB, …), nations their divisions with ISO codes, customers the settlements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.functions import naming
from placeforge.operators import assemble, classify, placement, tiers
from placeforge.plans.build import Scan, build
from placeforge.plans.release import trim
from placeforge.queries.graphs import nation_graph
from placeforge.queries.views import POINTS_SQL, points, table
from placeforge.schema import ENTITY
from placeforge.sources.writers import row_json

VILLAGE, DISTRICT = 900_004, 900_002


def entities(df: DataFrame, **columns: Column) -> DataFrame:
    """df as entity records; what isn't given is null."""
    return df.select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ENTITY])


def ref(c: Column) -> Column:
    return F.concat(F.lit("Q"), c.cast("string"))


def code(c: Column) -> Column:
    return F.concat(F.lit("R"), F.chr(c.cast("long") + 65))


def en(c: Column) -> Column:
    return F.create_map(F.lit("en"), c)


def world(spark: SparkSession, sf_dir: str) -> Scan:
    """The tables as a scan. Every ninth customer states no nation, every tenth of those is listed by it."""
    r, n, c = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    rk, nk, nr = F.col("r_regionkey").cast("long"), F.col("n_nationkey").cast("long"), F.col("n_regionkey").cast("long")
    countries = entities(r, id=rk + 900_000_00, labels=en(F.col("r_name")), instance_of=F.array(F.lit("Q6256")), iso_3166_1=F.array(code(rk)), capital=F.array(F.lit("Q1000001")))
    divisions = entities(
        n, id=nk + 910_000_00, labels=en(F.col("n_name")), instance_of=F.array(F.lit(f"Q{DISTRICT}")), country=ref(nr + 900_000_00),
        iso_3166_2=F.array(F.concat(code(nr), F.lit("-"), nk.cast("string"))), coord=F.lit("Point(1.5 2.5)"),
    )
    p = points(spark, sf_dir).join(c.select(F.col("c_custkey").alias("id"), "c_name", "c_acctbal"), "id").join(n.select(F.col("n_nationkey").cast("long").alias("nation"), nr.alias("home")), "nation")
    k = F.col("id")
    settled = entities(
        p, id=k + 1_000_000, labels=en(F.col("c_name")), instance_of=F.array(F.lit(f"Q{VILLAGE}")), country=ref(F.col("home") + 900_000_00),
        located_in=F.when(k % 9 != 0, F.array(ref(F.col("nation") + 910_000_00))), population=F.floor("c_acctbal").cast("long").cast("string"),
        coord=F.concat(F.lit("Point("), F.floor("lng").cast("string"), F.lit(" "), F.floor("lat").cast("string"), F.lit(")")),
    )
    up = p.select((k + 1_000_000).alias("child"), (F.col("nation") + 910_000_00).alias("parent"), k.alias("k"))
    sub = spark.createDataFrame([(VILLAGE, 486972), (DISTRICT, 56061)], "child long, parent long")
    return Scan(countries.union(divisions).union(settled), sub, up.filter("k % 9 <> 0").drop("k"), up.filter("k % 90 = 0").drop("k"))


def c6_build(spark, sf_dir):
    """The whole build: every settlement with its region."""
    s = build(spark, world(spark, sf_dir)).settlements
    return s.select("id", "admin1_id", "admin1_source", "country_code", "name", "slug", "latitude", "longitude", F.col("population").cast("string").alias("population"))


_HOME = "(SELECT n_nationkey, n_regionkey FROM nation)"
C6 = f"""WITH {POINTS_SQL}, w AS (SELECT p.id, p.nation, CAST(n_regionkey AS BIGINT) AS home, floor(lat) AS la, floor(lng) AS ln, c_name, c_acctbal FROM points p
  JOIN customer ON c_custkey = p.id JOIN {_HOME} n ON n.n_nationkey = p.nation)
SELECT id + 1000000 AS id, CASE WHEN id % 9 <> 0 OR id % 90 = 0 THEN nation + 91000000 ELSE home + 90000000 END AS admin1_id,
CASE WHEN id % 9 <> 0 OR id % 90 = 0 THEN 'stated' ELSE 'none' END AS admin1_source, 'R' || chr(CAST(home AS INTEGER) + 65) AS country_code,
c_name AS name, regexp_replace(regexp_replace(lower(regexp_replace(c_name, '[^A-Za-z0-9_\\s-]', '', 'g')), '^\\s+|\\s+$', '', 'g'), '[-\\s]+', '-', 'g') AS slug,
printf('%.6f', la) AS latitude, printf('%.6f', ln) AS longitude, CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS population FROM w"""


def c6_regions(spark, sf_dir):
    """The regions of the build with the settlements each holds."""
    b = build(spark, world(spark, sf_dir))
    n = b.settlements.groupBy(F.col("admin1_id").alias("id")).agg(F.count(F.lit(1)).alias("settlements"))
    return b.regions.join(n, "id", "left").select("id", "name", "country_code", "sole", "unassigned", F.coalesce("settlements", F.lit(0)).alias("settlements"))


C6R = f"""WITH x AS ({C6}), n AS (SELECT admin1_id, count(*) AS settlements FROM x GROUP BY admin1_id)
SELECT CAST(n_nationkey + 91000000 AS BIGINT) AS id, n_name AS name, 'R' || chr(CAST(n_regionkey AS INTEGER) + 65) AS country_code, FALSE AS sole, FALSE AS unassigned,
coalesce(settlements, 0) AS settlements FROM nation LEFT JOIN n ON admin1_id = n_nationkey + 91000000
UNION ALL SELECT CAST(r_regionkey + 90000000 AS BIGINT), r_name, 'R' || chr(CAST(r_regionkey AS INTEGER) + 65), FALSE, TRUE, settlements FROM region JOIN n ON admin1_id = r_regionkey + 90000000"""


def k10_trim(spark, sf_dir):
    """The ids of a scan cut to one country."""
    s = world(spark, sf_dir)
    return trim(s, spark.createDataFrame([(900_000_02,)], "country_qid long")).entities.select("id")


K10 = """SELECT c_custkey + 1000000 AS id FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2 OR c_custkey = 1
UNION SELECT CAST(n_nationkey + 91000000 AS BIGINT) FROM nation WHERE n_regionkey = 2 UNION SELECT CAST(90000002 AS BIGINT)"""


def f4_country_items(spark, sf_dir):
    e = world(spark, sf_dir).entities
    return e.filter("id < 2000000 or id >= 90000000").select("id", classify.is_country().alias("is_country"))


F4 = """SELECT c_custkey + 1000000 AS id, FALSE AS is_country FROM customer UNION ALL SELECT CAST(n_nationkey + 91000000 AS BIGINT), FALSE FROM nation
UNION ALL SELECT CAST(r_regionkey + 90000000 AS BIGINT), TRUE FROM region"""


def f8_country_filter(spark, sf_dir):
    return tiers.countries(world(spark, sf_dir).entities, ("ra", "RC ", "RX"))


F8 = "SELECT 'R' || chr(CAST(r_regionkey AS INTEGER) + 65) AS iso2, CAST(r_regionkey + 90000000 AS BIGINT) AS country_qid FROM region WHERE r_regionkey IN (0, 2)"


def f9_usable(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    label = F.element_at(F.array(F.col("p_name"), F.col("p_partkey").cast("string"), F.lit("--"), F.lit("Киров"), F.repeat(F.col("p_name"), 30)), (F.col("p_partkey") % 5).cast("int") + 1)
    return p.select("p_partkey", naming.usable_column(label).alias("usable"))


F9 = "SELECT p_partkey, p_partkey % 5 = 0 AS usable FROM part"


def f10_shippable(spark, sf_dir):
    """Why a row can't ship: no label, no coordinate, in that order of questions."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    e = entities(c, id=k, labels=en(F.when(k % 4 == 1, F.concat(F.lit("Q"), k.cast("string"))).when(k % 4 == 2, "..").otherwise(F.col("c_name"))), coord=F.when(k % 3 != 0, "Point(1 2)"))
    e = e.withColumns({"iso2": F.lit("XX"), "admin1_id": F.lit(1).cast("long"), "admin1_source": F.lit("stated"), "native": F.lit(None).cast("string"), "zone": F.lit(None).cast("string")})
    return assemble.settlement_rows(e).select("id", "reject")


F10 = "SELECT c_custkey AS id, CASE WHEN c_custkey % 4 IN (1, 2) THEN 'no_label' WHEN c_custkey % 3 = 0 THEN 'no_coord' END AS reject FROM customer"


def j3_country_rows(spark, sf_dir):
    """Country rows with looked-up capital, currency and continent."""
    r, s = table(spark, sf_dir, "region"), table(spark, sf_dir, "supplier")
    rk = F.col("r_regionkey").cast("long")
    items = entities(s, id=F.col("s_suppkey") + 500, labels=en(F.col("s_name")), currency_code=F.concat(F.lit("C"), F.col("s_suppkey").cast("string")), unit_symbol=F.lit("$"))
    own = entities(
        r, id=rk, labels=en(F.col("r_name")), capital=F.array(F.lit("x"), ref(rk + 500)), currency=F.array(ref(rk + 501)), continent=F.when(rk != 0, F.array(ref(rk + 502))),
        calling_code=F.array(F.lit("+2"), F.lit("+1")), demonym=F.create_map(F.lit("fr"), F.lit("Été")), population=F.lit("12"),
    )
    facts = own.withColumns({"iso2": code(F.col("id")), "native": F.lit("fr"), "zone": F.lit("Z")})
    rows = assemble.country_rows(assemble.country_names(facts), items)
    return rows.select("id", "code", "name", "capital_id", "capital_name", "currency_code", "currency_symbol", "continent_name", F.array_join("calling_code", ",").alias("calling_code"), "demonym", "tld", "population")


J3 = """SELECT CAST(r_regionkey AS BIGINT) AS id, 'R' || chr(CAST(r_regionkey AS INTEGER) + 65) AS code, r_name AS name, 'Q' || (r_regionkey + 500) AS capital_id, a.s_name AS capital_name,
'C' || b.s_suppkey AS currency_code, '$' AS currency_symbol, c.s_name AS continent_name, '+1,+2' AS calling_code, 'Ete' AS demonym, '.r' || chr(CAST(r_regionkey AS INTEGER) + 97) AS tld, CAST(12 AS BIGINT) AS population
FROM region JOIN supplier a ON a.s_suppkey = r_regionkey JOIN supplier b ON b.s_suppkey = r_regionkey + 1 LEFT JOIN supplier c ON c.s_suppkey = r_regionkey + 2 AND r_regionkey <> 0"""


def j11_parent_labels(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    e = entities(n, id=F.col("n_nationkey").cast("long"), labels=en(F.concat(F.col("n_name"), F.lit(" (x)"))))
    c = table(spark, sf_dir, "customer").select(ref(F.col("c_nationkey") + F.col("c_custkey") % 30).alias("admin2_id"), F.lit("XX").alias("country_code"), F.lit("fr").alias("native"))
    return assemble.parent_labels(e, c)


J11 = "SELECT DISTINCT 'Q' || n_nationkey AS admin2_id, 'XX' AS country_code, n_name AS parent_label FROM customer JOIN nation ON n_nationkey = c_nationkey + c_custkey % 30"


def g3_class_flags(spark, sf_dir):
    """All closures of the class table in two loops: one past the blocked classes, one up to them."""
    roots = {"settlement": (1000,), "hard": (1001,), "former": (1002, 3), "soft": (1003,), "rescue": (1004, 7), "not_a_place": (2,), "admin": (5,)}
    return classify.class_flags(nation_graph(spark, sf_dir), roots, blocked=(9, 11))


_ROOTS = "('settlement', CAST(1000 AS BIGINT)), ('hard', 1001), ('former', 1002), ('former', 3), ('soft', 1003), ('rescue', 1004), ('rescue', 7), ('not_a_place', 2), ('admin', 5)"
G3 = f"""WITH RECURSIVE e AS (SELECT CAST(n_nationkey AS BIGINT) AS child, CAST((n_nationkey * 7 + 3) % 25 AS BIGINT) AS parent FROM nation UNION SELECT CAST(n_nationkey AS BIGINT), CAST(n_regionkey + 1000 AS BIGINT) FROM nation),
c AS (SELECT * FROM (VALUES {_ROOTS}) t(tag, qid) UNION SELECT tag, child FROM e JOIN c ON parent = qid WHERE tag = 'settlement' OR qid NOT IN (9, 11))
SELECT qid, {', '.join(f"bool_or(tag = '{t}') AS {t}" for t in classify.FLAGS)} FROM c GROUP BY qid"""


def t4_claimed_divisions(spark, sf_dir):
    """Divisions that settlements name: nations, as the containers above customers that state the region."""
    s = world(spark, sf_dir)
    flags = s.entities.select("id", (F.col("id").between(91_000_000, 91_999_999) & (F.col("id") % 4 != 0)).alias("admin_class"), F.lit(False).alias("not_place"))
    plan = spark.range(5).select(code(F.col("id")).alias("iso2"), (F.col("id") + 90_000_000).alias("country_qid"))
    return tiers.tier4(s.entities.join(flags, "id"), s.entities.filter("id < 2000000").select("id"), plan).select("iso2", "qid")


T4 = """SELECT DISTINCT 'R' || chr(CAST(n_regionkey AS INTEGER) + 65) AS iso2, CAST(n_nationkey + 91000000 AS BIGINT) AS qid FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey % 9 <> 0 AND (n_nationkey + 91000000) % 4 <> 0"""


def g9_shard_climb(spark, sf_dir):
    """Settlements under the divisions that they name, nearest first."""
    s = world(spark, sf_dir)
    d = table(spark, sf_dir, "nation").filter("n_nationkey % 2 = 0").select((F.col("n_nationkey") + 91_000_000).cast("long").alias("qid"))
    return tiers.claimed(s.entities, s.entities.filter("id < 2000000").select("id"), d)


G9 = """SELECT c_custkey + 1000000 AS qid, CAST(1 AS INTEGER) AS depth, CAST(c_nationkey + 91000000 AS BIGINT) AS division FROM customer WHERE c_custkey % 9 <> 0 AND c_nationkey % 2 = 0"""


def x7_romanise(spark, sf_dir):
    """Part keys spelt in Cyrillic letters, and back in Latin ones."""
    p = table(spark, sf_dir, "part")
    label = F.translate(F.col("p_partkey").cast("string"), "0123456789", "абвгдезийк")
    n = naming.resolve_column(F.create_map(F.lit("ru"), label), F.lit("ru"))
    return p.select("p_partkey", n.alias("n")).select("p_partkey", F.col("n.name").alias("name"), F.col("n.lang").alias("lang"))


X7 = """WITH t AS (SELECT p_partkey, translate(CAST(p_partkey AS VARCHAR), '0123456789', 'abvgdeziyk') AS w FROM part)
SELECT p_partkey, upper(w[1]) || w[2:] AS name, 'ru' AS lang FROM t"""


def x10_strip_description(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    label = F.concat(F.lit("Munitsipalnoe obrazovanie <<Rabochiy poselok (pgt) "), F.col("p_name"), F.lit(">>"))
    n = naming.resolve_column(en(F.when(F.col("p_size") % 2 == 0, label).otherwise(F.col("p_name"))), F.lit(None).cast("string"))
    return p.select("p_partkey", n["name"].alias("name"))


X10 = "SELECT p_partkey, p_name AS name FROM part"


def a2_lowest_by_code(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return tiers.lowest_by_code(s.select((F.col("s_nationkey") % 5).cast("string").alias("iso2"), (F.col("s_suppkey") % 13).cast("string").alias("code"), F.col("s_suppkey").alias("qid")))


A2 = "SELECT CAST(s_nationkey % 5 AS VARCHAR) AS iso2, CAST(s_suppkey % 13 AS VARCHAR) AS code, min(s_suppkey) AS qid FROM supplier GROUP BY ALL"


def a8_totals(spark, sf_dir):
    """Totals over the counts of each country."""
    from placeforge.queries.places import placement_inputs

    counts = placement.placement_counts(placement.place(*placement_inputs(spark, sf_dir)))
    return counts.agg(*[F.sum(c).alias(c) for c in ("seen", "orphans", "unheld", "by_contains", "by_boundary")])


def o1_sorted_rows(spark, sf_dir):
    """Settlements in file order: their place by (name, id) in each region."""
    from pyspark.sql import Window

    from placeforge.queries.views import rows

    w = Window.partitionBy("admin1_id").orderBy("name", "id")
    return rows(spark, sf_dir).select("id", F.row_number().over(w).alias("place"))


O1 = "SELECT c_custkey AS id, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY 'place ' || (c_custkey % 64), c_custkey) AS INTEGER) AS place FROM customer"


def k2_nested_json(spark, sf_dir):
    """A country's divisions nested in order, keys sorted, as one compact document for each."""
    n = table(spark, sf_dir, "nation")
    g = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("divisions")).select(F.col("divisions"), F.col("n_regionkey").cast("long").alias("id"))
    return g.select("id", row_json(g, ("divisions", "id")).alias("doc"))


K2 = """SELECT CAST(n_regionkey AS BIGINT) AS id, '{"divisions":["' || string_agg(n_name, '","' ORDER BY n_name) || '"],"id":' || n_regionkey || '}' AS doc FROM nation GROUP BY n_regionkey"""

QUERIES = {
    "c6_build": (c6_build, C6), "c6_regions": (c6_regions, C6R), "k10_trim": (k10_trim, K10), "f4_country_items": (f4_country_items, F4),
    "f8_country_filter": (f8_country_filter, F8), "f9_usable": (f9_usable, F9), "f10_shippable": (f10_shippable, F10), "j3_country_rows": (j3_country_rows, J3),
    "j11_parent_labels": (j11_parent_labels, J11), "g3_class_flags": (g3_class_flags, G3), "t4_claimed_divisions": (t4_claimed_divisions, T4),
    "g9_shard_climb": (g9_shard_climb, G9), "x7_romanise": (x7_romanise, X7), "x10_strip_description": (x10_strip_description, X10),
    "a2_lowest_by_code": (a2_lowest_by_code, A2), "o1_sorted_rows": (o1_sorted_rows, O1), "k2_nested_json": (k2_nested_json, K2),
}


def _totals_sql() -> str:
    from placeforge.queries.places import A1

    return f"SELECT {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in ('seen', 'orphans', 'unheld', 'by_contains', 'by_boundary'))} FROM ({A1})"


QUERIES["a8_totals"] = (a8_totals, _totals_sql())
