"""Queries of classes, graphs and tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.operators import classify, graph, tiers
from placeforge.queries.views import TREE_SQL, table, tree


def brand_edges(spark, sf_dir) -> DataFrame:
    """A class graph from the parts: brand -> type, last word of the name -> brand (all by number)."""
    p = table(spark, sf_dir, "part")
    num = lambda c: F.crc32(c.cast("binary"))
    a = p.select(num(F.col("p_brand")).alias("child"), num(F.col("p_type")).alias("parent"))
    b = p.select(num(F.element_at(F.split("p_name", " "), -1)).alias("child"), num(F.col("p_brand")).alias("parent"))
    return a.union(b).distinct()


def nation_graph(spark, sf_dir) -> DataFrame:
    """A graph with cycles: each nation under (7 * key + 3) % n and under its region + 1000."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey").cast("long")
    return n.select(k.alias("child"), F.explode(F.array((k * 7 + 3) % 25, F.col("n_regionkey").cast("long") + 1000)).alias("parent"))


NATION_SQL = """e AS (SELECT CAST(n_nationkey AS BIGINT) AS child, CAST((n_nationkey * 7 + 3) % 25 AS BIGINT) AS parent FROM nation
  UNION SELECT CAST(n_nationkey AS BIGINT), CAST(n_regionkey + 1000 AS BIGINT) FROM nation)"""


def g1_closure(spark, sf_dir):
    return graph.closure(tree(spark, sf_dir), (0, 3))


G1 = f"""WITH RECURSIVE {TREE_SQL}, c AS (SELECT CAST(unnest([0, 3]) AS BIGINT) AS qid UNION SELECT child FROM tree JOIN c ON parent = qid) SELECT qid FROM c"""


def g1_blocked(spark, sf_dir):
    return graph.closure(tree(spark, sf_dir), (1, 2), blocked=(101, 102, 107, 108))


G1B = f"""WITH RECURSIVE {TREE_SQL}, c AS (SELECT CAST(unnest([1, 2]) AS BIGINT) AS qid
UNION SELECT child FROM tree JOIN c ON parent = qid WHERE qid NOT IN (101, 102, 107, 108)) SELECT qid FROM c"""


def g2_tagged_closures(spark, sf_dir):
    roots = spark.createDataFrame([("hard", 1000), ("soft", 1001), ("soft", 1002), ("rescue", 4)], "tag string, qid long")
    return graph.closures(nation_graph(spark, sf_dir), roots, blocked=(9,))


G2 = f"""WITH RECURSIVE {NATION_SQL}, c AS (SELECT * FROM (VALUES ('hard', CAST(1000 AS BIGINT)), ('soft', 1001), ('soft', 1002), ('rescue', 4)) t(tag, qid)
UNION SELECT tag, child FROM e JOIN c ON parent = qid WHERE qid <> 9) SELECT tag, qid FROM c"""


def g4_reach_up(spark, sf_dir):
    t = tree(spark, sf_dir)
    return graph.reach_up(t, t.select(F.col("child").alias("qid")))


G4 = f"""WITH RECURSIVE {TREE_SQL}, c AS (SELECT child AS qid FROM tree
UNION SELECT parent FROM tree JOIN c ON child = qid) SELECT qid FROM c"""


def g5_ancestors(spark, sf_dir):
    e = nation_graph(spark, sf_dir)
    return graph.ancestors(e, e.select(F.col("child").alias("qid")).distinct(), 12)


G5 = f"""WITH RECURSIVE {NATION_SQL}, c AS (SELECT DISTINCT child AS qid, child AS ancestor, 0 AS hop FROM e
UNION SELECT qid, parent, hop + 1 FROM e JOIN c ON child = ancestor WHERE hop < 12)
SELECT qid, ancestor, CAST(min(hop) AS INTEGER) AS hop FROM c WHERE hop > 0 GROUP BY qid, ancestor"""


def g6_nearest_seed(spark, sf_dir):
    """Seeds at two levels: every third nation, and the regions one step further out."""
    n = table(spark, sf_dir, "nation").filter("n_nationkey % 3 = 0").select((F.col("n_nationkey") + 100).cast("long").alias("qid"), F.lit(0).alias("depth"))
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("qid"), F.lit(1).alias("depth"))
    return graph.nearest_seed(tree(spark, sf_dir), n.union(r).withColumn("division", F.col("qid")))


G6 = f"""WITH RECURSIVE {TREE_SQL}, c AS (
SELECT CAST(n_nationkey + 100 AS BIGINT) AS qid, 0 AS depth, CAST(n_nationkey + 100 AS BIGINT) AS division FROM nation WHERE n_nationkey % 3 = 0
UNION SELECT CAST(r_regionkey AS BIGINT), 1, CAST(r_regionkey AS BIGINT) FROM region
UNION SELECT child, depth + 1, division FROM tree JOIN c ON parent = qid)
SELECT qid, CAST(depth AS INTEGER) AS depth, division FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY depth, division) AS rn FROM c) WHERE rn = 1"""


def g6_cycles(spark, sf_dir):
    seeds = spark.createDataFrame([(1000, 0, 1000), (1003, 0, 1003), (5, 2, 5)], "qid long, depth int, division long")
    return graph.nearest_seed(nation_graph(spark, sf_dir), seeds)


G6C = f"""WITH RECURSIVE {NATION_SQL}, c AS (SELECT * FROM (VALUES (CAST(1000 AS BIGINT), 0, CAST(1000 AS BIGINT)), (1003, 0, 1003), (5, 2, 5)) t(qid, depth, division)
UNION SELECT child, depth + 1, division FROM e JOIN c ON parent = qid WHERE depth < 30)
SELECT qid, CAST(depth AS INTEGER) AS depth, division FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY depth, division) AS rn FROM c) WHERE rn = 1"""


def g7_contains_rescue(spark, sf_dir):
    """Containment of every fifth nation is stated only by its region."""
    t = tree(spark, sf_dir)
    moved = (F.col("child") < 1000) & (F.col("child") % 5 == 0)
    divisions = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("qid"))
    return graph.rescue_walk(t.filter(~moved), t.filter(moved), divisions)


G7 = f"""WITH RECURSIVE {TREE_SQL}, c AS (SELECT CAST(r_regionkey AS BIGINT) AS qid, 0 AS depth, CAST(r_regionkey AS BIGINT) AS division FROM region
UNION SELECT child, depth + 1, division FROM tree JOIN c ON parent = qid)
SELECT qid, CAST(min(depth) AS INTEGER) AS depth, min(division) AS division FROM c GROUP BY qid"""


def g8_root_most(spark, sf_dir):
    t = tree(spark, sf_dir)
    picked = t.filter("child % 4 = 0 or child in (101, 103)").select(F.col("child").alias("qid"))
    return graph.root_most(t, picked)


G8 = f"""WITH {TREE_SQL}, s AS (SELECT child AS qid FROM tree WHERE child % 4 = 0 OR child IN (101, 103))
SELECT qid FROM s JOIN tree a ON a.child = qid LEFT JOIN tree b ON b.child = a.parent
WHERE a.parent NOT IN (SELECT qid FROM s) AND (b.parent IS NULL OR b.parent NOT IN (SELECT qid FROM s))"""


def g10_linked_groups(spark, sf_dir):
    """Orders of one customer on neighbouring days form chains."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).alias("d"))
    a, b = o.toDF("a", "c", "d1"), o.toDF("b", "c", "d2")
    return graph.linked_groups(a.join(b, "c").filter("a < b and abs(d1 - d2) <= 30").select("a", "b"))


G10 = """WITH RECURSIVE o AS (SELECT o_orderkey AS k, o_custkey AS c, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS d FROM orders),
g AS (SELECT k, c, d, CASE WHEN d - lag(d) OVER w <= 30 THEN 0 ELSE 1 END AS new FROM o WINDOW w AS (PARTITION BY c ORDER BY d, k)),
n AS (SELECT k, c, sum(new) OVER (PARTITION BY c ORDER BY d, k ROWS UNBOUNDED PRECEDING) AS grp FROM g)
SELECT k AS node, min(k) OVER (PARTITION BY c, grp) AS root FROM n QUALIFY count(*) OVER (PARTITION BY c, grp) > 1"""

_CLASSES = """c AS (SELECT p_partkey AS id, p_type AS t, p_brand AS b, string_split(p_name, ' ')[-1] AS w, p_size FROM part)"""


def class_entities(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Parts as entities with three classes, and a flag table over those classes."""
    p = table(spark, sf_dir, "part")
    num = lambda c: F.crc32(c.cast("binary"))
    ref = lambda c: F.concat(F.lit("Q"), num(c).cast("string"))
    word = F.element_at(F.split("p_name", " "), -1)
    ents = p.select(
        F.col("p_partkey").alias("id"), F.array(ref(F.col("p_type")), ref(F.col("p_brand")), ref(word), F.lit("x")).alias("instance_of"),
        F.when(F.col("p_size") == 1, "1900").alias("dissolved"), F.lit(None).cast("string").alias("end_time"),
    )
    texts = p.select(F.explode(F.array("p_type", "p_brand", word)).alias("t")).distinct()
    is_word = texts.join(p.select(word.alias("t")).distinct().withColumn("w", F.lit(True)), "t", "left").withColumn("w", F.coalesce("w", F.lit(False)))
    last = F.substring("t", -1, 1)
    flags = is_word.select(
        num(F.col("t")).alias("qid"),
        (F.col("w") | (F.col("t").startswith("Brand") & last.isin("1", "2"))).alias("settlement"),
        (F.col("t").startswith("Brand") & (last == "5")).alias("hard"),
        (F.col("w") & (F.length("t") % 2 == 0)).alias("former"),
        (F.col("t").startswith("Brand") & (last == "4")).alias("soft"),
        (~F.col("w") & ~F.col("t").startswith("Brand") & (F.length("t") % 2 == 0)).alias("rescue"),
        F.lit(False).alias("not_a_place"), F.lit(False).alias("admin"),
    )
    return ents, flags


def f1_settlement(spark, sf_dir):
    ents, flags = class_entities(spark, sf_dir)
    return classify.settlements(ents, flags).select("id")


F1 = f"""WITH {_CLASSES} SELECT id FROM c WHERE right(b, 1) <> '5' AND p_size <> 1
AND NOT (length(w) % 2 = 0 AND right(b, 1) NOT IN ('1', '2')) AND (right(b, 1) <> '4' OR length(t) % 2 = 0)"""


def f2_excluded_division(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    e = p.select(
        F.col("p_partkey").alias("id"), F.array(F.when(F.col("p_size") % 10 == 0, "Q15087423").otherwise("Q5")).alias("instance_of"),
        F.when(F.col("p_size") == 7, "").otherwise(F.when(F.col("p_size") == 8, "x")).alias("dissolved"), F.lit(None).cast("string").alias("end_time"),
    )
    return e.select("id", classify.excluded_division().alias("excluded"))


F2 = "SELECT p_partkey AS id, (p_size % 10 = 0 OR p_size = 8) AS excluded FROM part"


def f3_not_a_place(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    e = p.select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 2 == 0, F.array(F.lit("XX-1"))).alias("iso_3166_2"), (F.col("p_size") > 20).alias("flag"))
    return e.select("id", classify.not_a_place(F.col("flag")).alias("not_a_place"))


F3 = "SELECT p_partkey AS id, (p_size % 2 <> 0 AND p_size > 20) AS not_a_place FROM part"


def supplier_codes(spark, sf_dir) -> DataFrame:
    """Suppliers as coded entities: one or two codes under their nation's letters."""
    s = table(spark, sf_dir, "supplier")
    iso = F.concat(F.lit("N"), F.chr(F.col("s_nationkey").cast("long") + 65))
    code = lambda m: F.concat(iso, F.lit("-"), (F.col("s_suppkey") % m).cast("string"))
    none = lambda t: F.lit(None).cast(t)
    return s.select(
        F.col("s_suppkey").alias("id"), F.array(code(7), F.lit("XX-9"), code(3)).alias("iso_3166_2"), none("array<string>").alias("iso_3166_1"),
        F.array(F.lit("Q5")).alias("instance_of"), F.when(F.col("s_suppkey") % 11 == 0, "1900").alias("dissolved"), none("string").alias("end_time"),
        F.lit(False).alias("not_place"), iso.alias("own"),
    )


_SUPP = """s AS (SELECT s_suppkey AS id, 'N' || chr(CAST(s_nationkey AS INTEGER) + 65) AS iso2, s_suppkey % 11 = 0 AS gone,
  least('N' || chr(CAST(s_nationkey AS INTEGER) + 65) || '-' || (s_suppkey % 7), 'N' || chr(CAST(s_nationkey AS INTEGER) + 65) || '-' || (s_suppkey % 3)) AS code FROM supplier)"""


def supplier_plan(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation").filter("n_nationkey % 2 = 0")
    return n.select(F.concat(F.lit("N"), F.chr(F.col("n_nationkey").cast("long") + 65)).alias("iso2"), (F.col("n_nationkey") + 900_000).cast("long").alias("country_qid"))


def no_edges(spark) -> DataFrame:
    return spark.createDataFrame([], "child long, parent long")


def f5_code_prefix(spark, sf_dir):
    return tiers.tier1(supplier_codes(spark, sf_dir), supplier_plan(spark, sf_dir), no_edges(spark)).select("iso2", "qid", "code")


F5 = f"""WITH {_SUPP} SELECT iso2, min(id) AS qid, code FROM s WHERE NOT gone AND ascii(substr(iso2, 2)) % 2 = 65 % 2 GROUP BY iso2, code"""


def t3_gone_divisions(spark, sf_dir):
    return tiers.tier3(supplier_codes(spark, sf_dir), supplier_plan(spark, sf_dir), no_edges(spark)).select("iso2", "qid", "code")


T3 = f"""WITH {_SUPP} SELECT iso2, id AS qid, code FROM s WHERE ascii(substr(iso2, 2)) % 2 = 65 % 2"""


def t2_children(spark, sf_dir):
    """Customers as children of their nation; every third is administrative."""
    c = table(spark, sf_dir, "customer")
    none = lambda t: F.lit(None).cast(t)
    e = c.select(
        F.col("c_custkey").alias("id"), none("array<string>").alias("iso_3166_2"), F.when(F.col("c_custkey") % 7 == 0, F.array(F.lit("AA"))).alias("iso_3166_1"),
        F.array(F.lit("Q5")).alias("instance_of"), none("string").alias("dissolved"), F.when(F.col("c_custkey") % 5 == 0, "x").alias("end_time"),
        F.lit(False).alias("not_place"), (F.col("c_custkey") % 3 == 0).alias("admin_class"),
    )
    edges = c.select(F.col("c_custkey").alias("child"), (F.col("c_nationkey") + 900_000).cast("long").alias("parent"))
    return tiers.tier2(e, supplier_plan(spark, sf_dir), edges).select("iso2", "qid", "code")


T2 = """SELECT 'N' || chr(CAST(c_nationkey AS INTEGER) + 65) AS iso2, c_custkey AS qid, CAST(NULL AS VARCHAR) AS code FROM customer
WHERE c_nationkey % 2 = 0 AND c_custkey % 3 = 0 AND c_custkey % 5 <> 0 AND c_custkey % 7 <> 0"""


def t_tier_choice(spark, sf_dir):
    """Which tier answers for each nation: coded suppliers, else administrative customers, else the nation itself."""
    plan = supplier_plan(spark, sf_dir)
    one = tiers.tier1(supplier_codes(spark, sf_dir).filter("id % 4 = 0"), plan, no_edges(spark)).select("iso2").distinct().withColumn("tier", F.lit(1))
    two = t2_children(spark, sf_dir).select("iso2").distinct().withColumn("tier", F.lit(2))
    five = tiers.tier5(plan).select("iso2").withColumn("tier", F.lit(5))
    return one.union(two).union(five).groupBy("iso2").agg(F.min("tier").alias("tier"))


TC = f"""WITH {_SUPP}, k AS (SELECT 'N' || chr(CAST(n_nationkey AS INTEGER) + 65) AS iso2 FROM nation WHERE n_nationkey % 2 = 0)
SELECT iso2, CAST(CASE WHEN iso2 IN (SELECT iso2 FROM s WHERE NOT gone AND id % 4 = 0) THEN 1
WHEN iso2 IN (SELECT 'N' || chr(CAST(c_nationkey AS INTEGER) + 65) FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 5 <> 0 AND c_custkey % 7 <> 0) THEN 2 ELSE 5 END AS INTEGER) AS tier FROM k"""


def t7_attachment(spark, sf_dir):
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    g = o.groupBy("c_nationkey", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("seen"), F.count_if(F.col("o_orderstatus") != "F").alias("unheld"),
        F.count_if(F.col("o_orderkey") % 6 != 0).alias("orphans"), F.count_if(F.col("o_orderkey") % 2 == 0).alias("claimed"),
    )
    g = g.withColumn("iso2", F.concat(F.col("c_nationkey").cast("string"), F.lit(" "), F.col("o_orderpriority"))).withColumn("claimed", F.when(F.col("c_nationkey") % 2 == 0, F.col("claimed")).otherwise(F.lit(0)))
    return tiers.attachment(g).select("iso2", "decision")


T7 = """WITH g AS (SELECT c_nationkey || ' ' || o_orderpriority AS iso2, count(*) AS seen, count(*) FILTER (o_orderstatus <> 'F') AS unheld,
count(*) FILTER (o_orderkey % 6 <> 0) AS orphans, CASE WHEN c_nationkey % 2 = 0 THEN count(*) FILTER (o_orderkey % 2 = 0) ELSE 0 END AS claimed
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, o_orderpriority)
SELECT iso2, CASE WHEN NOT (unheld >= 5 AND seen - unheld < unheld) THEN 'keep' WHEN claimed > 0 AND claimed >= greatest(2 * (seen - unheld), seen - unheld + 5) THEN 'claim'
WHEN seen - orphans < 0.25 * orphans THEN 'flatten' ELSE 'keep' END AS decision FROM g"""


def a10_tier_histogram(spark, sf_dir):
    return tiers.tier_histogram(t_tier_choice(spark, sf_dir))


A10 = TC.replace("SELECT iso2, CAST(CASE", "SELECT tier, count(*) AS countries FROM (SELECT iso2, CAST(CASE") + ") GROUP BY tier"


def j2_country_items(spark, sf_dir):
    """The lowest live item of each code."""
    c = table(spark, sf_dir, "customer")
    e = c.select(F.col("c_custkey").alias("id"), F.array(F.col("c_mktsegment"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))).alias("iso_3166_1"), F.when(F.col("c_custkey") % 10 < 3, "x").alias("dissolved"), F.lit(None).cast("string").alias("end_time"))
    return tiers.countries(e)


J2 = """WITH x AS (SELECT unnest([c_mktsegment, 'n' || c_nationkey]) AS iso2, c_custkey AS id FROM customer), m AS (SELECT iso2, min(id) AS country_qid FROM x GROUP BY iso2)
SELECT iso2, country_qid FROM m WHERE country_qid % 10 >= 3"""

QUERIES = {
    "g1_closure": (g1_closure, G1), "g1_blocked": (g1_blocked, G1B), "g2_tagged_closures": (g2_tagged_closures, G2), "g4_reach_up": (g4_reach_up, G4),
    "g5_ancestors": (g5_ancestors, G5), "g6_nearest_seed": (g6_nearest_seed, G6), "g6_cycles": (g6_cycles, G6C), "g7_contains_rescue": (g7_contains_rescue, G7),
    "g8_root_most": (g8_root_most, G8), "g10_linked_groups": (g10_linked_groups, G10), "f1_settlement": (f1_settlement, F1),
    "f2_excluded_division": (f2_excluded_division, F2), "f3_not_a_place": (f3_not_a_place, F3), "f5_code_prefix": (f5_code_prefix, F5),
    "t2_children": (t2_children, T2), "t3_gone_divisions": (t3_gone_divisions, T3), "t_tier_choice": (t_tier_choice, TC), "t7_attachment": (t7_attachment, T7),
    "a10_tier_histogram": (a10_tier_histogram, A10), "j2_country_items": (j2_country_items, J2),
}
