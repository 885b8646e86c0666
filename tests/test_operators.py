import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from placeforge import constants as K
from placeforge.functions.text import fixed, slug
from placeforge.operators import classify, collisions, gates, graph, placement, spatial, tiers
from placeforge.queries import places
from placeforge.sources import files, shapefile, triples

EDGE = "child long, parent long"


def edges(spark, pairs):
    return spark.createDataFrame(pairs, EDGE)


def qids(df):
    return sorted(r.qid for r in df.collect())


def test_closure_and_blocked(spark):
    e = edges(spark, [(2, 1), (3, 2), (4, 3)])
    assert qids(graph.closure(e, [1])) == [1, 2, 3, 4]
    assert qids(graph.closure(e, [1], blocked=(2,))) == [1, 2]


def test_closure_of_cycles_ends_and_of_long_chains_fails(spark):
    assert qids(graph.closure(edges(spark, [(1, 2), (2, 1)]), [1])) == [1, 2]
    with pytest.raises(RuntimeError):
        graph.closure(edges(spark, [(k + 1, k) for k in range(8)]), [0], max_rounds=5)


def nearest(spark, pairs, seeds):
    s = spark.createDataFrame(seeds, "qid long, depth int, division long")
    return {r.qid: (r.depth, r.division) for r in graph.nearest_seed(edges(spark, pairs), s).collect()}


def test_nearest_seed(spark):
    got = nearest(spark, [(10, 2), (10, 5), (5, 1), (7, 99)], [(1, 0, 1), (2, 0, 2)])
    assert got[10] == (1, 2) and got[5] == (1, 1) and 7 not in got  # nearest, not lowest; unreachable
    assert nearest(spark, [(10, 2), (10, 1)], [(1, 0, 1), (2, 0, 2)])[10] == (1, 1)  # ties: lowest
    assert nearest(spark, [(10, 2), (10, 1)], [(1, 3, 1), (2, 0, 2)])[10] == (1, 2)  # coarse loses
    assert nearest(spark, [(1, 2)], [(1, 3, 1), (2, 0, 2)])[1] == (1, 2)  # a seed may get a nearer one


def test_rescue_walk(spark):
    d = spark.createDataFrame([(1,)], "qid long")
    got = graph.rescue_walk(edges(spark, [(20, 10)]), edges(spark, [(10, 1)]), d).collect()
    assert {r.qid: r.division for r in got} == {1: 1, 10: 1, 20: 1}
    assert graph.rescue_walk(edges(spark, [(20, 10)]), edges(spark, []), d).count() == 0


def test_ancestors_and_root_most(spark):
    e = edges(spark, [(3, 2), (2, 1), (5, 5), (6, 7), (7, 6)])
    got = {(r.qid, r.ancestor, r.hop) for r in graph.ancestors(e, spark.createDataFrame([(3,), (6,)], "qid long"), 12).collect()}
    assert got == {(3, 2, 1), (3, 1, 2), (6, 7, 1), (6, 6, 2)}
    assert qids(graph.root_most(e, spark.createDataFrame([(3,), (1,), (5,)], "qid long"))) == [1, 5]


def entity(qid, classes, **k):
    return (qid, [f"Q{c}" for c in classes], k.get("dissolved"), k.get("end_time"))


def test_settlement_predicate(spark):
    flags = spark.createDataFrame(
        [(1, True, False, False, False, False, False, False), (2, True, False, True, False, False, False, False), (3, False, True, False, False, False, False, False), (4, False, False, False, True, False, False, False), (5, False, False, False, False, True, False, False)],
        "qid long, settlement boolean, hard boolean, former boolean, soft boolean, rescue boolean, not_a_place boolean, admin boolean",
    )
    rows = [entity(10, [1]), entity(11, [1, 3]), entity(12, [2, 1]), entity(13, [2]), entity(14, [1], dissolved="1978"), entity(15, [1, 4]), entity(16, [1, 4, 5]), entity(17, [9]), entity(K.SANDBOX_ENTITIES[0], [1]), entity(18, []), entity(19, [1], dissolved="")]
    df = spark.createDataFrame(rows, "id long, instance_of array<string>, dissolved string, end_time string")
    assert sorted(r.id for r in classify.settlements(df, flags).collect()) == [10, 12, 16, 19]


def place_row(qid, name, lat, lng, parent=None, label=None, **extra):
    r = {"id": qid, "source": "wikidata", "admin1_id": 1, "admin1_source": "stated", "country_code": "XX", "name": name, "name_lang": "en", "slug": slug(name), "latitude": fixed(lat), "longitude": fixed(lng), "admin2_id": parent, "population": None, "geonames_id": None, "alt_names": {}, "native_label": [], "parent_label": label, "upstream_qualifier": None}
    return {**r, **extra}


PLACE = (
    "id long, source string, admin1_id long, admin1_source string, country_code string, name string, name_lang string, slug string, latitude string, "
    "longitude string, admin2_id string, population long, geonames_id long, alt_names map<string,array<string>>, native_label array<string>, "
    "parent_label string, upstream_qualifier string"
)


def place_rows(spark, groups):
    """One frame of many groups, each a region of its own, unless the rows say otherwise."""
    cols = [c.split()[0] for c in PLACE.split(", ")]
    return spark.createDataFrame([tuple({**r, "admin1_id": g}[c] for c in cols) for g, rows in groups.items() for r in rows], PLACE)


def test_collisions_merge(spark):
    groups = {
        1: [place_row(747074, "Aalen", 48.837222, 10.093611), place_row(31868047, "Aalen", 48.837840, 10.092990)],
        2: [place_row(100, "Abla", 37.142222, -2.777222, geonames_id=2521886), place_row(200, "Abla", 37.142567, -2.777509, population=1421)],
        3: [place_row(3, "Ourem", 39.65, -8.58), place_row(1, "Ourem", 39.6635, -8.58), place_row(2, "Ourem", 39.677, -8.58)],
        4: [place_row(11, "A", 0, 0, alt_names={"en": ["b"]}, native_label=["y"], admin1_source=""), place_row(12, "A", 0, 0, "Q8", "Eight", alt_names={"en": ["a"], "fr": ["c"]}, native_label=["x"])],
        5: [place_row(21, "B", 0, 0, "Q7"), place_row(22, "B", 0, 0, "Q8", "Eight"), place_row(23, "B", 10, 0)],
        6: [place_row(31, "C", 0, 0)],
    }
    got = {r.id: r for r in collisions.merge_close(place_rows(spark, groups)).collect()}
    assert set(got) == {747074, 100, 1, 11, 21, 23, 31}
    assert (got[100].population, got[100].geonames_id) == (1421, 2521886)
    assert got[11].alt_names == {"en": ["a", "b"], "fr": ["c"]} and got[11].native_label == ["x", "y"]
    assert (got[11].admin1_source, got[11].admin2_id, got[11].parent_label) == ("stated", "Q8", "Eight")
    assert (got[21].admin2_id, got[21].parent_label) == ("Q7", None)  # a label goes with its parent
    assert collisions.merge_close(place_rows(spark, {6: groups[6]})).count() == 1


def test_absorbed_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [(1, 5, "c", "z", 1), (1, 5, "b", "y", 0), (1, 5, "", "x", 2), (1, None, "a", "a", 3), (2, 4, None, "w", 4)]
    for data in (rows, rows[::-1]):
        df = spark.createDataFrame(data, "g int, pos int, v string, w string, at int").coalesce(1)
        assert [tuple(r) for r in collisions.absorb_groups(df, "g", "pos", ["v", "w"], {"w": "v"}).orderBy("g").collect()] == [(1, 5, "b", "y"), (2, 4, None, None)]
        assert [tuple(r) for r in collisions.absorb_groups(df, "g", "pos", ["v", "w"], ties=("at",)).orderBy("g").collect()] == [(1, 5, "b", "y"), (2, 4, None, "w")]


def test_absorb_query_takes_the_first_line_of_the_table(spark, tmp_path):
    """Of lines of one order, number and part the SQL takes the first on one thread, also where the table is several files."""
    import duckdb

    lines = [(k % 50, k % 2 + 1, k % 3, (k * 7919) % 1000) for k in range(2000)]
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long"
    whole, parts = tmp_path / "whole", tmp_path / "parts"
    spark.createDataFrame(lines, schema).coalesce(1).write.parquet(str(whole / "lineitem.parquet"))
    for k, cut in enumerate((slice(0, 50), slice(50, 2000))):
        spark.createDataFrame(lines[cut], schema).coalesce(1).write.parquet(str(tmp_path / f"cut{k}"))
        (parts / "lineitem.parquet").mkdir(parents=True, exist_ok=True)
        next((tmp_path / f"cut{k}").glob("*.parquet")).rename(parts / "lineitem.parquet" / f"part-{k}.parquet")
    for folder in (whole, parts):
        con = duckdb.connect(config={"threads": 1})
        con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{folder}/lineitem.parquet/*.parquet'")
        want = con.sql(places.A5).fetchall()
        got = [tuple(r) for r in places.a5_absorb(spark, str(folder)).collect()]
        assert sorted(got) == sorted(want) and len(got) == 50


def test_collisions_qualify(spark):
    groups = {
        7: ([place_row(1, "Aach", 48.4675, 8.478611, "Q7167", "Zollernalbkreis"), place_row(2, "Aach", 47.8425, 8.853889, "Q7169", "Konstanz")], ["Aach", "Aach (Konstanz)"]),
        8: ([place_row(3, "Sarna", 45.4, 16.0, "Q900", "Kutina"), place_row(4, "Sarna", 45.0, 16.0, "Q900", "Kutina")], ["Sarna", "Sarna (south Kutina)"]),
        9: ([place_row(5, "Sarna", 45.0, 16.0, population=800), place_row(6, "Sarna", 45.2, 16.3)], ["Sarna"]),
        10: ([place_row(7, "Ruse", 43.8, 25.9, "Q1", "Ruse", population=142902), place_row(8, "Ruse", 43.4, 26.2, "Q2", "Vetovo", population=300)], ["Ruse", "Ruse (Vetovo)"]),
        11: ([place_row(9, "Bogota", 4.61, -74.08, "Q2", "Cundinamarca", population=8034649), place_row(10, "Bogota", 5.05, -74.0, "Q1", "Central Savanna", population=61549)], ["Bogota", "Bogota (Central Savanna)"]),
        12: ([place_row(11, "Drvar", 44.4, 16.0, "Q9", "Drvar Municipality"), place_row(12, "Drvar", 44.0, 16.0, "Q9", "Drvar Municipality")], ["Drvar", "Drvar (south)"]),
        13: ([place_row(13, "Hopewell", 34.0, -86.0, "Q13", "Alabama", population=5), place_row(14, "Hopewell", 33.0, -86.0, "Q13", "Alabama")], ["Hopewell"]),
        14: ([place_row(15, "Floq", 41.0, 20.0, upstream_qualifier="Klos"), place_row(16, "Floq", 41.5, 20.5, population=9)], ["Floq (Klos)", "Floq"]),
        # Two of three say the same upstream: the first takes it, the largest that has nothing stays plain, the other goes.
        15: ([place_row(17, "Mali", 1, 1, upstream_qualifier="Ost"), place_row(18, "Mali", 2, 2, upstream_qualifier="Ost"), place_row(19, "Mali", 3, 3, population=4)], ["Mali (Ost)", "Mali"]),
        # A parent shared by two tells neither apart, but their sectors do; the third has a parent of its own.
        16: ([place_row(20, "Lug", 45.0, 16.0, "Q1", "Sisak"), place_row(21, "Lug", 45.5, 16.0, "Q1", "Sisak"), place_row(22, "Lug", 45.2, 16.9, "Q2", "Zagreb")], ["Lug", "Lug (north Sisak)", "Lug (Zagreb)"]),
        17: ([place_row(23, "Solo", 0, 0)], ["Solo"]),
        18: ([place_row(24, "Zero", 1, 1, population=0), place_row(25, "Zero", 9, 9, "", "")], ["Zero"]),
    }
    got = collisions.qualify(place_rows(spark, {g: rows for g, (rows, _) in groups.items()})).orderBy("id").collect()
    for g, (_, want) in groups.items():
        assert [r.name for r in got if r.admin1_id == g] == want
    assert {r.slug for r in got if r.id == 4} == {"sarna-south-kutina"} and all(r.slug == slug(r.name) for r in got)


def test_collisions_frame(spark):
    rows = [place_row(1, "Aach", 48.4675, 8.478611, "Q1", "One"), place_row(2, "Aach", 47.8425, 8.853889, "Q2", "Two"), place_row(3, "Aach (Two)", 1, 1, population=7), place_row(4, "Solo", 2, 2, alt_names={"en": ["x"]})]
    out = collisions.resolve_collisions(place_rows(spark, {1: rows}))
    assert {r.id: r.name for r in out.collect()} == {1: "Aach", 3: "Aach (Two)", 4: "Solo"}  # the sweep keeps the larger of two equal slugs
    assert "parent_label" not in out.columns
    assert collisions.resolve_collisions(place_rows(spark, {})).count() == 0


def test_votes(spark):
    cols = "iso2 string, id long, code string, division long"
    rows = [("A", k, "A-1", 7) for k in range(10)] + [("A", 99, "A-1", 8)] + [("A", 100 + k, "A-2", 5 + k % 2) for k in range(20)] + [("A", 200 + k, "A-3", 1) for k in range(4)]
    s = spark.createDataFrame(rows, cols)
    got = {(r.code, r.division) for r in placement.vote(s).collect()}
    assert got == {("A-1", 7)}
    again = {(r.code, r.division) for r in placement.vote(s, s.filter("code = 'A-2' and division = 6")).collect()}
    assert again == {("A-1", 7), ("A-2", 6)}


def shape_zip(code, box):
    west, south, east, north = box
    ring = [(west, south), (west, north), (east, north), (east, south), (west, south)]
    body = struct.pack("<i4d2i", 5, *box, 1, 5) + struct.pack("<i", 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    shp = b"\0" * 100 + struct.pack(">2i", 1, len(body) // 2) + body
    field = b"ISO_3166_2".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([10]) + b"\0" * 15
    dbf = struct.pack("<4BIHH", 3, 0, 0, 0, 1, 65, 11) + b"\0" * 20 + field + b"\r" + b" " + code.encode().ljust(10, b"\0")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("x.shp", shp)
        z.writestr("x.dbf", dbf)
    return out.getvalue()


def test_shapefile(spark, tmp_path):
    rows = shapefile.read_polygons(shape_zip("AL-01", (19.5, 41.0, 20.5, 42.0)))
    assert rows[0][:6] == (0, "AL-01", 19.5, 41.0, 20.5, 42.0) and rows[0][6][0][0] is False
    for bad in ("", "-99", "AL", "AL-~1"):
        assert shapefile.read_polygons(shape_zip(bad, (0, 0, 1, 1))) == []
    with pytest.raises(ValueError, match="iso_3166_2"):
        shapefile.read_polygons(shape_zip("AL-01", (0, 0, 1, 1)), "other")
    (tmp_path / "b.zip").write_bytes(shape_zip("AL-01", (19.5, 41.0, 20.5, 42.0)))
    p = shapefile.polygons(spark, str(tmp_path / "b.zip"))
    pts = spark.createDataFrame([(1, 41.5, 20.0), (2, 40.9, 20.0), (3, 41.97, 20.0)], "id long, lat double, lng double")
    assert [(r.id, r.code) for r in spatial.locate(pts, p).orderBy("id").collect()] == [(1, "AL-01"), (3, "AL-01")]
    inside = spatial.well_inside(pts.withColumn("code", F.lit("AL-01")), p)
    assert [r.id for r in inside.collect()] == [1]


def test_holes_and_islands(spark):
    ring = lambda hole, a, b: (hole, [a, a, b, b, a], [a, b, b, a, a])
    p = spark.createDataFrame([(0, "X-1", 0.0, 0.0, 9.0, 9.0, [ring(False, 0.0, 9.0), ring(True, 2.0, 7.0), ring(False, 4.0, 5.0)])], shapefile.SCHEMA)
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 3.0), (3, 4.5, 4.5), (4, -0.5, 1.0)], "id long, lat double, lng double")
    assert sorted(r.id for r in spatial.locate(pts, p).collect()) == [1, 3]


def test_files(spark, tmp_path):
    (tmp_path / "z.tab").write_text("# c\nFR,MC\t+1+1\tEurope/Paris\nUS\t+1+1\tA\nUS\t+1+1\tB\n\n")
    assert {r.iso2: r.zone for r in files.single_zones(spark, str(tmp_path / "z.tab")).collect()} == {"FR": "Europe/Paris", "MC": "Europe/Paris"}
    assert files.single_zones(spark, str(tmp_path / "none.tab")).count() == 0
    e = edges(spark, [(1, 2), (3, 4)]).coalesce(1)
    files.write_packed_edges(e, str(tmp_path / "g.i32"))
    assert sorted(tuple(r) for r in files.read_packed_edges(spark, str(tmp_path / "g.i32")).collect()) == [(1, 2), (3, 4)]
    (tmp_path / "bad.i32").write_bytes(b"\1" * 12)
    with pytest.raises(Exception, match="inside a pair"):
        files.read_packed_edges(spark, str(tmp_path / "bad.i32")).collect()
    (tmp_path / "m.json").write_text('{"locations": [{"country_code": "AL", "cities": 3}]}')
    assert [tuple(r) for r in files.read_manifest(spark, str(tmp_path / "m.json")).collect()] == [("AL", 3, 0)]
    (tmp_path / "1.jsonl").write_text('{"id": 5, "labels": {"en": "x"}}\n')
    r = files.read_records(spark, str(tmp_path)).first()
    assert r.id == 5 and r.labels == {"en": "x"} and r.coord is None


DUMP = r"""<http://www.wikidata.org/entity/Q5> <http://www.w3.org/2000/01/rdf-schema#label> "a \"x\"@en"@fr .
<http://www.wikidata.org/entity/Q5> <http://www.w3.org/2000/01/rdf-schema#label> "second"@fr .
<http://www.wikidata.org/entity/Q5> <http://www.w3.org/2004/02/skos/core#altLabel> "aliasé"@fr .
<http://www.wikidata.org/entity/Q5> <http://www.wikidata.org/prop/direct/P131> <http://www.wikidata.org/entity/Q7> .
<http://www.wikidata.org/entity/Q5> <http://www.wikidata.org/prop/direct/P131> <http://www.wikidata.org/entity/Q6> .
<http://www.wikidata.org/entity/Q5> <http://www.wikidata.org/prop/direct/P131> <http://www.wikidata.org/entity/Q7>
<http://www.wikidata.org/entity/Q5> <http://www.wikidata.org/prop/direct/P1082> "+5"^^<http://x#decimal> .
<http://www.wikidata.org/entity/Q5> <http://www.wikidata.org/prop/direct/P1082> "+6"^^<http://x#decimal> .
<http://www.wikidata.org/entity/Q5> <http://www.wikidata.org/prop/direct/P576> _:b1 .
<http://www.wikidata.org/entity/Q5> <http://www.wikidata.org/prop/direct/P17> _:b2 .
<http://www.wikidata.org/entity/Q5> <http://www.wikidata.org/prop/direct/P625> "broken .
<http://www.wikidata.org/entity/Q8> <http://www.wikidata.org/prop/direct/P150> <http://www.wikidata.org/entity/Q5> .
<http://www.wikidata.org/entity/Q8> <http://www.wikidata.org/prop/direct/P31> <http://www.wikidata.org/entity/Q1> .
<http://www.wikidata.org/entity/P31> <http://www.wikidata.org/prop/direct/P31> <http://www.wikidata.org/entity/Q1> .
<http://www.wikidata.org/entity/Q9> <http://www.wikidata.org/prop/direct/P9999> "x" .
"""


def test_dump_scan(spark, tmp_path):
    (tmp_path / "dump.nt").write_text(DUMP)
    out = triples.scan(spark, str(tmp_path / "dump.nt"), str(tmp_path / "out"))
    rows = {r.id: r for r in out["entities"].collect()}
    assert set(rows) == {5}  # Q8 holds nothing that keeps it, but its edge stays
    r = rows[5]
    assert r.labels == {"fr": 'a "x"@en'} and r.alt_labels == {"fr": ["aliasé"]} and r.located_in == ["Q7", "Q6"]
    assert r.population == "+5" and r.dissolved == "somevalue" and r.country is None and str(r.shard) == "0"
    assert {tuple(x) for x in out["contains"].collect()} == {(5, 8)}
    assert {tuple(x) for x in out["located_in"].collect()} == {(5, 7), (5, 6)}
    s = triples.statistics(triples.parse_lines(triples.read_lines(spark, str(tmp_path / "dump.nt")))).first()
    assert (s.bad_lines, s.blank_nodes, s.labels) == (1, 2, 2)


def test_stream_equals_batch(spark, tmp_path):
    from placeforge.streaming import triples as stream

    lines = DUMP.splitlines(keepends=True)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.nt").write_text("".join(lines[:6]))
    (tmp_path / "in/b.nt").write_text("".join(lines[6:]))
    q = stream.start(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), files_per_batch=1)
    q.awaitTermination(120)
    got = {r.id: r for r in stream.records(spark, str(tmp_path / "out")).collect()}
    assert sorted(got[5].located_in) == ["Q6", "Q7"] and got[5].dissolved == "somevalue" and got[8].contains == ["Q5"]
    touched = {r.id: r for r in stream.records(spark, str(tmp_path / "out"), [0]).collect()}
    assert touched and all(got[k] == r for k, r in touched.items())  # whole records of what the batch touched


def test_tier_rules(spark):
    cols = "id long, iso_3166_2 array<string>, iso_3166_1 array<string>, instance_of array<string>, dissolved string, end_time string, not_place boolean"
    rows = [(10, ["UA-40"], None, [], None, None, False), (9, ["UA-40"], None, [], None, None, False), (11, ["UA-1"], ["UX"], [], None, None, False), (12, ["UA-2"], None, [], "x", None, False), (13, ["GB-EAW", "GB-1"], None, [], None, None, False), (209706, ["UA-3"], None, [], None, None, False), (15, ["UA-4", "UA-3"], None, ["Q202595"], None, None, False), (16, ["UA-5"], None, [], None, None, True), (17, ["UA-7", "UA-6"], None, [], None, None, False)]
    df = spark.createDataFrame(rows, cols)
    plan = spark.createDataFrame([("UA", 1), ("GB", 2)], "iso2 string, country_qid long")
    got = {(r.iso2, r.qid, r.code) for r in tiers.tier1(df, plan, edges(spark, [])).collect()}
    assert got == {("UA", 9, "UA-40"), ("UA", 17, "UA-6")}
    assert 12 in {r.qid for r in tiers.tier3(df, plan, edges(spark, [])).collect()}


def test_gates_flip_once(spark):
    countries = spark.createDataFrame([(f"C{k}", "Cap") for k in range(10)], "code string, capital_name string")
    rows = spark.createDataFrame([(f"C{k}", "cap", "1", "2") for k in range(10)], "country_code string, slug string, latitude string, longitude string")
    man = lambda n: spark.createDataFrame([(f"C{k}", n) for k in range(10)], "code string, settlements long")
    ok = lambda *a: {r.gate: r.ok for r in gates.run_gates(*a).collect()}
    assert all(ok(countries, rows, man(100), man(100)).values())
    assert ok(countries, rows, man(60), man(100)) | {"settlement loss": True, "countries below ratio": True} == ok(countries, rows, man(100), man(100))
    assert not ok(countries, rows, man(100).filter("code <> 'C1'"), man(100))["country loss"]
    assert not ok(countries, rows.filter("country_code <> 'C1'"), man(1))["capitals missing"]
    assert not ok(countries.withColumn("capital_name", F.lit("")), rows, man(1))["capitals named"]
    assert not ok(countries, rows.withColumn("latitude", F.lit(None).cast("string")), man(1))["coordinate coverage"]


def test_country_files_are_whole_and_nested(tmp_path):
    from placeforge.sources import writers

    for f in writers.FORMATS:
        (tmp_path / f).mkdir()
    settlement = lambda k: dict.fromkeys(writers.CSV_COLUMNS[5:]) | {"id": k, "name": f"s{k}é"}
    country = {"code": "ZZ", "name": "Zed", "slug": "zed", "id": 9, "zz": [1], "alpha": None}
    rows = [(0, country), (1, {"id": 1, "name": "R", "slug": "r", "tail": 1}), (2, settlement(3)), (2, settlement(4)), (1, {"id": 2, "name": "S", "slug": "s"})]
    files_ = writers.CountryFiles(str(tmp_path), "ZZ")
    for level, doc in rows:
        files_.add(level, doc)
    assert not (tmp_path / "json/ZZ.json").exists()
    entry = files_.close()
    want = {**country, "regions": [{**rows[1][1], "settlements": [settlement(3), settlement(4)]}, {**rows[4][1], "settlements": []}]}
    raw = (tmp_path / "json/ZZ.json").read_text(encoding="utf-8")
    assert raw == writers.compact(want, sort_keys=True) and entry["bytes"]["json"] == len(raw.encode())
    assert (entry["regions"], entry["settlements"]) == (2, 2) and len((tmp_path / "data/ZZ.ndjson").read_text().splitlines()) == 5
    assert sorted(p.name for f in writers.FORMATS for p in (tmp_path / f).iterdir()) == ["ZZ.csv", "ZZ.json", "ZZ.ndjson"]
    empty = writers.CountryFiles(str(tmp_path), "AA")
    empty.add(0, {"code": "AA"})
    empty.close()
    assert (tmp_path / "json/AA.json").read_text() == '{"code":"AA","regions":[]}'
