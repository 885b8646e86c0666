"""All queries over the star-schema tables, with their SQL."""

from placeforge.queries import builds, graphs, places, scans

ALL = {**scans.QUERIES, **graphs.QUERIES, **places.QUERIES, **builds.QUERIES}
QUERIES = {name: f for name, (f, _) in ALL.items()}
ORACLE = {name: sql for name, (_, sql) in ALL.items() if sql}
