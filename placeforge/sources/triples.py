"""From an N-Triples dump to entity records and edges.

Lines are filtered by subject and predicate before an object is looked at. Parsing is one projection; then one
shuffle by subject builds the records. The order of values in the dump is kept by (file part, line) position.
Edges branch off before records are filtered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge import constants as K
from placeforge.functions.text import unescape_column
from placeforge.schema import ENTITY


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """line and pos (increasing within each part of the input)."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.monotonically_increasing_id().alias("pos"))


_SUBJECT = f"<{K.ENTITY_IRI}Q"


def settled(df: DataFrame, *columns) -> DataFrame:
    """The columns, worked out once: filters above are not pushed into them.

    Catalyst would write a pushed filter out in full, with every nested cut repeated for each mention.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def parse_lines(lines: DataFrame) -> DataFrame:
    """subject, field, value, lang, pos, kind of the lines that are kept; kind is iri, lit, blank or bad.

    Kept are lines with an entity subject and a listed property, a label or an alias. Most lines of a dump end at
    the two filters, which only cut at the first angle brackets; the object is looked at after them. Whitespace
    and the dot at the end are optional, as dumps are cut.
    """
    fields = {K.DIRECT_IRI + p: f for p, f in K.PROPERTIES.items()} | {K.LABEL_IRI: "labels", K.ALIAS_IRI: "alt_labels"}
    rest = F.substring("line", len(_SUBJECT) + 1, 1 << 30)
    cut = lines.filter(F.col("line").startswith(_SUBJECT)).select(F.substring_index(rest, ">", 1).alias("q"), rest.alias("rest"), "pos")
    cut = cut.select("q", F.substring("rest", F.length("q") + 4, F.lit(1 << 30)).alias("rest"), "pos")
    cut = settled(cut, "q", F.substring_index("rest", ">", 1).alias("predicate"), "rest", "pos").filter(F.col("predicate").isin(list(fields)))
    end = F.rtrim(F.substring("rest", F.length("predicate") + 3, F.lit(1 << 30)), F.lit(" \t\r"))
    undotted = F.when(end.endswith("."), F.rtrim(F.substring(end, F.lit(1), F.length(end) - 1), F.lit(" \t\r"))).otherwise(end)
    names = F.create_map(*[F.lit(x) for kv in fields.items() for x in kv])
    named = settled(cut, F.col("q").try_cast("bigint").alias("subject"), F.element_at(names, F.col("predicate")).alias("field"), undotted.alias("object"), "pos")
    parsed = with_object(named.filter(F.col("subject").isNotNull()))
    return parsed.select("subject", "field", "value", "lang", "pos", "kind")


def with_object(df: DataFrame) -> DataFrame:
    """Add kind, value and lang from `object`.

    An entity IRI is its id, another IRI stays whole, a literal loses its datatype, a blank node counts as
    'somevalue' and only where presence is all that matters.
    """
    o = F.col("object")
    iri = o.startswith("<") & o.endswith(">")
    literal = o.rlike(r'(?s)^".*"(?:@[^"]*|\^\^<[^"]*>)?\z')
    blank = o.startswith("_:")
    kind = F.when(iri, "iri").when(blank, "blank").when(literal, "lit").otherwise("bad")
    known = settled(df, *df.columns, kind.alias("kind"))
    is_iri, is_literal, o = F.col("kind") == "iri", F.col("kind") == "lit", F.col("object")
    inner = F.when(is_literal, F.regexp_extract(o, r'(?s)^"(.*)"(?:@[^"]*|\^\^<[^"]*>)?\z', 1))
    bare = o.substr(F.lit(2), F.length(o) - 2)
    iri_value = F.when(bare.startswith(K.ENTITY_IRI), bare.substr(F.lit(len(K.ENTITY_IRI) + 1), F.length(bare))).otherwise(bare)
    lang = F.when(is_literal & F.contains(o, F.lit('"@')), F.nullif(F.regexp_extract(o, r'(?s)"@([^"]*)\z', 1), F.lit("")))
    raw = F.when(is_iri, iri_value).when(is_literal, inner).when(F.col("kind") == "blank", "somevalue")
    out = settled(known, *known.columns, raw.alias("value"), lang.alias("lang"))
    return out.withColumn("value", F.when(F.col("kind") == "lit", unescape_column(F.col("value"))).otherwise(F.col("value")))


def kept_statements(parsed: DataFrame) -> DataFrame:
    """Statements that take part: no bad objects, blank nodes only on dates, labels only with a language."""
    by_lang = F.col("field").isin("labels", "alt_labels", "demonym")
    return parsed.filter(
        (F.col("kind") != "bad")
        & ((F.col("kind") != "blank") | F.col("field").isin(*K.PRESENCE_FIELDS))
        & (~by_lang | F.col("lang").isNotNull())
    )


def group_subjects(statements: DataFrame) -> DataFrame:
    """One row for each subject: first scalars, ordered distinct lists, first text and all aliases by language.

    Lists and `contains` are null where the subject has none. One shuffle by subject serves both groupings: first
    the ordered values of each field, then a map of the fields of each subject.
    """
    dealt = statements.repartition("subject")
    rows = F.array_sort(F.collect_list(F.struct("pos", "value", "lang"))).alias("rows")
    by_field = dealt.groupBy("subject", "field").agg(rows)
    g = by_field.groupBy(F.col("subject").alias("id")).agg(F.map_from_entries(F.collect_list(F.struct("field", "rows"))).alias("m"))
    field = lambda f: F.try_element_at("m", F.lit(f))
    values = lambda f: F.transform(field(f), lambda x: x["value"])
    langs = lambda f: F.array_distinct(F.transform(field(f), lambda x: x["lang"]))
    of = lambda f, k: F.filter(field(f), lambda x: x["lang"] == k)
    first = lambda f: F.map_from_entries(F.transform(langs(f), lambda k: F.struct(k, F.element_at(of(f, k), 1)["value"])))
    every = lambda f: F.map_from_entries(F.transform(langs(f), lambda k: F.struct(k, F.transform(of(f, k), lambda x: x["value"]))))
    cols = {f.name: F.get(field(f.name), F.lit(0))["value"] for f in ENTITY if f.dataType.simpleString() == "string"}
    cols |= {f: F.array_distinct(values(f)) for f in K.MULTI_FIELDS}
    cols |= {"id": F.col("id"), "labels": first("labels"), "demonym": first("demonym"), "alt_labels": every("alt_labels")}
    return g.select(*[cols[n].alias(n) for n in (*[f.name for f in ENTITY], "contains")])


def edges(grouped: DataFrame) -> dict[str, DataFrame]:
    """child, parent of subclass_of, located_in and (turned around) contains, from every subject."""
    ref = lambda c: F.when(c.rlike("^Q[0-9]+$"), c.substr(2, 20).try_cast("bigint"))

    def of(field: str, turned: bool = False) -> DataFrame:
        e = grouped.select(F.col("id").alias("child"), F.explode(field).alias("p"))
        e = e.select("child", ref(F.col("p")).alias("parent")).filter(F.col("parent").isNotNull())
        return e.select(F.col("parent").alias("child"), F.col("child").alias("parent")) if turned else e

    return {"subclass": of("subclass_of"), "located_in": of("located_in"), "contains": of("contains", turned=True)}


def keep(grouped: DataFrame) -> DataFrame:
    """Records with any of the fields that matter, plus the shard they belong to (0 without a country)."""
    some = F.coalesce(*[F.col(f).cast("string") for f in K.KEEP_IF]).isNotNull()
    shard = F.coalesce(F.nullif(F.regexp_extract("country", "^Q([0-9]+)$", 1), F.lit("")), F.lit("0"))
    return grouped.filter(some).select(*[f.name for f in ENTITY], shard.alias("shard"))


def statistics(parsed: DataFrame) -> DataFrame:
    """One row of counts over the parsed statements."""
    of = lambda c: F.count_if(c).alias
    return parsed.agg(
        F.count(F.lit(1)).alias("triples_kept"),
        of(F.col("field") == "labels")("labels"),
        of(F.col("field") == "alt_labels")("alt_labels"),
        of(F.col("kind") == "blank")("blank_nodes"),
        of(F.col("kind") == "bad")("bad_lines"),
        F.count_distinct("subject").alias("entities_seen"),
    )


def scan(spark: SparkSession, path: str, out: str) -> dict[str, DataFrame]:
    """Read a dump, write entities (by shard) and edges as Parquet under `out`, and return them."""
    grouped = group_subjects(kept_statements(parse_lines(read_lines(spark, path))))
    grouped.write.mode("overwrite").parquet(f"{out}/subjects")
    grouped = spark.read.parquet(f"{out}/subjects")
    keep(grouped).repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(f"{out}/entities")
    for name, e in edges(grouped).items():
        e.write.mode("overwrite").parquet(f"{out}/{name}")
    names = ("entities", "subclass", "located_in", "contains")
    return {n: spark.read.parquet(f"{out}/{n}") for n in names}
