"""An invented country: records and edges of a small scan."""

from placeforge.plans.build import Scan
from placeforge.schema import ENTITY

COUNTRY, DISTRICT, TOWN, VILLAGE = 900001, 900002, 900003, 900004


def record(qid, **fields):
    return tuple(qid if f.name == "id" else fields.get(f.name) for f in ENTITY)


def scan(spark, coded=False, decoy=False, duplicates=(), contains=(), polygons=None, drop_located=(), zones=None, extra=()):
    """Two districts, a town in each, three villages in each town. Nothing states that a district is in the country,
    unless the districts have codes."""
    q = lambda n: f"Q{n}"
    rows = [record(COUNTRY, iso_3166_1=["ZZ"], capital=["Q910001"], instance_of=["Q6256"], labels={"en": "Testland"})]
    located, sub = [], [(TOWN, 486972), (VILLAGE, 486972), (DISTRICT, 56061)]
    if decoy:
        rows.append(record(920001, country=q(COUNTRY), instance_of=[q(DISTRICT)], located_in=[q(COUNTRY)], coord="Point(99.0 50.0)", labels={"en": "Decoy"}))
        located.append((920001, COUNTRY))
    for i, d in enumerate((910001, 910002)):
        rows.append(record(d, country=q(COUNTRY), instance_of=[q(DISTRICT)], coord=f"Point({10 + i}.0 50.0)", labels={"en": f"District {i + 1}"}, iso_3166_2=[f"ZZ-0{i + 1}"] if coded else None))
        t = d + 100
        rows.append(record(t, country=q(COUNTRY), instance_of=[q(TOWN)], located_in=[q(d)], coord=f"Point({10 + i}.0 50.0)", labels={"en": f"Town {i + 1}"}))
        located.append((t, d))
        for v in range(3):
            n = t * 10 + v
            rows.append(record(n, country=q(COUNTRY), instance_of=[q(VILLAGE)], located_in=None if n in drop_located else [q(t)], coord=f"Point({10 + i}.{v + 1} 50.0)", labels={"en": f"Village {i + 1}{v + 1}"}))
            if n not in drop_located:
                located.append((n, t))
    for k, (n, target, parent) in enumerate(duplicates):
        rows.append(record(n, country=q(COUNTRY), instance_of=[q(VILLAGE)], same_as=[q(target)], located_in=[q(parent)] if parent else None, coord="Point(10.9 50.0)", labels={"en": f"Copy {k + 1}"}))
        if parent:
            located.append((n, parent))
    rows += extra
    edges = lambda e: spark.createDataFrame(list(e), "child long, parent long")
    return Scan(spark.createDataFrame(rows, ENTITY), edges(sub), edges(located), edges(contains), polygons, zones)
