"""Queries of the dump scan and the readers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge import constants as K
from placeforge.queries.views import table
from placeforge.sources import files, triples
from placeforge.tables import shared_dir

_E, _D = f"<{K.ENTITY_IRI}Q", f"<{K.DIRECT_IRI}"


def _statement(subject, prop: str, obj):
    return F.concat(F.lit(_E), subject.cast("string"), F.lit(f"> {_D}{prop}> "), obj, F.lit(" ."))


def _label(subject, text, lang: str, iri: str = K.LABEL_IRI):
    return F.concat(F.lit(_E), subject.cast("string"), F.lit(f'> <{iri}> "'), text, F.lit(f'"@{lang} .'))


def _item(c):
    return F.concat(F.lit(_E), c.cast("string"), F.lit(">"))


def nation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations as dump lines, with lines that a scan has to drop."""
    n = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    lines = F.array(
        _statement(key, "P131", _item(F.col("n_regionkey"))),
        _label(key, F.col("n_name"), "en"),
        _label(key, F.lower("n_name"), "fr"),
        _label(key, F.lit("second"), "en"),
        _label(key, F.concat(F.lit("alias "), F.col("n_name")), "en", K.ALIAS_IRI),
        _statement(key, "P9999", F.lit('"dropped"')),
        _statement(key, "P1082", F.concat(F.lit('"+'), (key * 10).cast("string"), F.lit('"^^<http://www.w3.org/2001/XMLSchema#decimal>'))),
        F.concat(F.lit("<http://example.org/x> "), F.lit(f"{_D}P31> "), _item(key), F.lit(" .")),
    )
    return n.select(F.explode(lines).alias("line")).withColumn("pos", F.monotonically_increasing_id())


def s3_parse_triples(spark, sf_dir):
    g = triples.group_subjects(triples.kept_statements(triples.parse_lines(nation_lines(spark, sf_dir))))
    return g.select(
        "id", F.try_element_at("labels", F.lit("en")).alias("en"), F.try_element_at("labels", F.lit("fr")).alias("fr"),
        F.get("located_in", F.lit(0)).alias("located_in"), "population", F.try_element_at("alt_labels", F.lit("en"))[0].alias("alias"),
    )


S3 = """SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS en, lower(n_name) AS fr, 'Q' || n_regionkey AS located_in,
  '+' || (n_nationkey * 10) AS population, 'alias ' || n_name AS alias FROM nation"""


def s2_line_trim(spark, sf_dir):
    """Lines with and without the final dot, and cut ones: how each object reads."""
    o = table(spark, sf_dir, "orders")
    end = F.element_at(F.array(F.lit(" ."), F.lit(""), F.lit("  .  "), F.lit("\t.\r")), (F.col("o_orderkey") % 4).cast("int") + 1)
    body = F.concat(F.lit(_E), F.col("o_orderkey").cast("string"), F.lit(f"> {_D}P17> "), _item(F.col("o_custkey")), end)
    got = triples.parse_lines(o.select(body.alias("line"), F.monotonically_increasing_id().alias("pos")))
    return got.select(F.col("subject").alias("id"), "field", "value", "kind")


S2 = "SELECT o_orderkey AS id, 'country' AS field, 'Q' || o_custkey AS value, 'iri' AS kind FROM orders"


def s4_lang_tags(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    text = F.concat(F.lit('"say \\"x\\"@y '), F.col("c_name"), F.lit('"@en-gb'))
    got = triples.with_object(c.select(F.col("c_custkey").alias("id"), text.alias("object")))
    return got.select("id", "value", "lang", "kind")


S4 = """SELECT c_custkey AS id, 'say "x"@y ' || c_name AS value, 'en-gb' AS lang, 'lit' AS kind FROM customer"""


def s5_unescape(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    text = F.concat(F.lit('"'), F.col("p_name"), F.lit('\\t\\u00e9\\\\n"@fr'))
    return triples.with_object(p.select(F.col("p_partkey").alias("id"), text.alias("object"))).select("id", "value")


S5 = "SELECT p_partkey AS id, p_name || chr(9) || 'é' || chr(92) || 'n' AS value FROM part"


def s6_presence_marker(spark, sf_dir):
    """Blank nodes count on dates and nowhere else."""
    o = table(spark, sf_dir, "orders")
    prop = F.when(F.col("o_orderstatus") == "F", "P576").otherwise("P1082")
    line = F.concat(F.lit(_E), F.col("o_orderkey").cast("string"), F.lit(f"> {_D}"), prop, F.lit("> _:b ."))
    got = triples.kept_statements(triples.parse_lines(o.select(line.alias("line"), F.monotonically_increasing_id().alias("pos"))))
    return got.select(F.col("subject").alias("id"), "field", "value")


S6 = "SELECT o_orderkey AS id, 'dissolved' AS field, 'somevalue' AS value FROM orders WHERE o_orderstatus = 'F'"


def s7_group_subjects(spark, sf_dir):
    """Orders as subjects, their lines as values in order: first scalar, ordered distinct list."""
    li = table(spark, sf_dir, "lineitem")
    base = li.select(F.col("l_orderkey").alias("subject"), F.lit(None).cast("string").alias("lang"), F.lit("lit").alias("kind"), "l_linenumber", "l_returnflag", "l_partkey")
    two = base.select("subject", "lang", "kind", F.explode(F.array(
        F.struct(F.lit("instance_of").alias("field"), F.col("l_returnflag").alias("value"), ((F.col("l_linenumber").cast("long") * 1_000_000_000 + F.col("l_partkey")) * 128 + F.ascii("l_returnflag")).alias("pos")),
        F.struct(F.lit("population").alias("field"), F.col("l_partkey").cast("string").alias("value"), ((F.col("l_linenumber").cast("long") * 1_000_000_000 + F.col("l_partkey")) * 128 + F.ascii("l_returnflag")).alias("pos")),
    )).alias("s"))
    g = triples.group_subjects(two.select("subject", "lang", "kind", "s.*"))
    return g.select("id", F.array_join("instance_of", ",").alias("flags"), "population")


S7 = """WITH l AS (SELECT l_orderkey AS id, l_returnflag AS f, l_partkey AS p, (CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey) * 128 + ascii(l_returnflag) AS pos FROM lineitem),
a AS (SELECT id, f, min(pos) AS pos FROM l GROUP BY id, f)
SELECT a.id, string_agg(f, ',' ORDER BY pos) AS flags, (SELECT CAST(arg_min(p, l.pos) AS VARCHAR) FROM l WHERE l.id = a.id) AS population FROM a GROUP BY a.id"""


def s8_keep_filter(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    blank = F.lit(None).cast("string")
    lists = ("located_in", "subclass_of", "iso_3166_2", "iso_3166_1")
    cols = {f.name: F.lit(None).cast(f.dataType) for f in triples.ENTITY}
    cols |= {"id": F.col("p_partkey"), "coord": F.when(F.col("p_size") < 10, "Point(1 2)").otherwise(blank), "currency_code": F.when(F.col("p_brand") == "Brand#11", F.col("p_name"))}
    cols |= {lists[0]: F.when(F.col("p_size") > 45, F.array(F.lit("Q1"))), "country": F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Q"), F.col("p_size").cast("string")))}
    return triples.keep(p.select(*[c.alias(k) for k, c in cols.items()])).select("id", "shard")


S8 = """SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE '0' END AS shard FROM part
WHERE p_size < 10 OR p_brand = 'Brand#11' OR p_size > 45"""


def s9_edges(spark, sf_dir):
    """Both containment relations from the same records; the parent's one comes out turned around."""
    n = table(spark, sf_dir, "nation")
    g = n.groupBy("n_regionkey").agg(F.collect_list(F.concat(F.lit("Q"), (F.col("n_nationkey") + 100).cast("string"))).alias("contains"))
    g = g.select(F.col("n_regionkey").cast("long").alias("id"), "contains", F.array(F.lit("Q7"), F.lit("x")).alias("located_in"), F.array(F.lit("Q8")).alias("subclass_of"))
    e = triples.edges(g)
    return e["located_in"].withColumn("relation", F.lit("located_in")).union(e["contains"].withColumn("relation", F.lit("contains")))


S9 = """SELECT CAST(r_regionkey AS BIGINT) AS child, CAST(7 AS BIGINT) AS parent, 'located_in' AS relation FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)
UNION ALL SELECT CAST(n_nationkey + 100 AS BIGINT), CAST(n_regionkey AS BIGINT), 'contains' FROM nation"""


def s13_json_records(spark, sf_dir):
    """Events written as shards of JSON lines and read as records with the fixed schema."""
    e, path = table(spark, sf_dir, "events"), f"{shared_dir(spark)}/records-{uuid.uuid4().hex}"
    shard = (F.col("user_id") % 16).cast("string").alias("shard")
    files.write_records(e.select(F.col("event_id").alias("id"), F.array("event_type").alias("instance_of"), F.col("user_id").cast("string").alias("population"), shard), path)
    r = files.read_records(spark, path)
    return r.select("id", F.col("instance_of")[0].alias("kind"), "population", F.col("coord").isNull().alias("no_coord"))


S13 = "SELECT event_id AS id, event_type AS kind, CAST(user_id AS VARCHAR) AS population, TRUE AS no_coord FROM events"


def s16_single_zone(spark, sf_dir):
    """Orders as countries, their suppliers as zones: those with exactly one."""
    li = table(spark, sf_dir, "lineitem")
    lines = li.select(F.concat(F.lit("p"), F.col("l_orderkey").cast("string"), F.lit("\t+0+0\tzone/"), F.col("l_suppkey").cast("string")).alias("value"))
    return files.zones_of(lines)


S16 = "SELECT 'P' || l_orderkey AS iso2, 'zone/' || min(l_suppkey) AS zone FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) = 1"


def s17_allow_list(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    line = F.when(key % 5 == 0, F.concat(F.lit("# "), F.col("s_name"))).when(key % 5 == 1, "  ").when(key % 5 == 2, F.concat(F.lit("s"), key.cast("string"), F.lit(":"))).otherwise(F.concat(F.lit(" s"), key.cast("string"), F.lit(" : why: "), F.col("s_name")))
    return files.allow_list(s.select(line.alias("value")))


S17 = """SELECT 'S' || s_suppkey AS code, CASE WHEN s_suppkey % 5 = 2 THEN '(no reason given)' ELSE 'why: ' || s_name END AS reason
FROM supplier WHERE s_suppkey % 5 > 1"""


def s19_scan_statistics(spark, sf_dir):
    return triples.statistics(triples.parse_lines(nation_lines(spark, sf_dir)))


S19 = """SELECT count(*) * 6 AS triples_kept, count(*) * 3 AS labels, count(*) AS alt_labels, CAST(0 AS BIGINT) AS blank_nodes,
CAST(0 AS BIGINT) AS bad_lines, count(DISTINCT n_nationkey) AS entities_seen FROM nation"""

QUERIES = {
    "s2_line_trim": (s2_line_trim, S2), "s3_parse_triples": (s3_parse_triples, S3), "s4_lang_tags": (s4_lang_tags, S4),
    "s5_unescape": (s5_unescape, S5), "s6_presence_marker": (s6_presence_marker, S6), "s7_group_subjects": (s7_group_subjects, S7),
    "s8_keep_filter": (s8_keep_filter, S8), "s9_edges": (s9_edges, S9), "s13_json_records": (s13_json_records, S13),
    "s16_single_zone": (s16_single_zone, S16), "s17_allow_list": (s17_allow_list, S17), "s19_scan_statistics": (s19_scan_statistics, S19),
}
