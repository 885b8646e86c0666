"""What an entity is, from its classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge import constants as K
from placeforge.operators.graph import closures, ids

FLAGS = ("settlement", "hard", "former", "soft", "rescue", "not_a_place", "admin")


def class_flags(subclass: DataFrame, roots: dict[str, tuple[int, ...]] | None = None, blocked=K.CLOSURE_BLOCKED) -> DataFrame:
    """qid and one boolean for each of FLAGS.

    The settlement closure ignores the blocked classes, all others stop at them. Rescue joins the core city
    classes and the administrative ones; not-a-place joins exact classes and two closures.
    """
    spark = subclass.sparkSession
    r = roots or {
        "settlement": K.SETTLEMENT_ROOTS, "hard": K.HARD_EXCLUDE_ROOTS, "former": K.FORMER_ROOTS,
        "soft": K.SOFT_EXCLUDE_ROOTS, "rescue": (*K.CORE_CITY_ROOTS, K.ADMIN_ROOT),
        "not_a_place": K.NOT_A_PLACE_ROOTS, "admin": (K.ADMIN_ROOT,),
    }
    frame = lambda tags: spark.createDataFrame([(t, int(q)) for t in tags for q in r.get(t, ())], "tag string, qid long")
    open_ = closures(subclass, frame(["settlement"]))
    shut = closures(subclass, frame([t for t in FLAGS if t != "settlement"]), tuple(blocked))
    rows = open_.union(shut)
    if roots is None:
        exact = spark.createDataFrame([("not_a_place", q) for q in K.NOT_A_PLACE_CLASSES], "tag string, qid long")
        rows = rows.union(exact)
    return rows.groupBy("qid").agg(*[F.bool_or(F.col("tag") == t).alias(t) for t in FLAGS])


def entity_flags(entities: DataFrame, flags: DataFrame) -> DataFrame:
    """id and, over its classes: hit, hard, soft, rescue, all_former (of its settlement classes), not_a_place, admin.

    One join on the class and one grouping on the id. The class table is small next to the entities; whether
    it is broadcast is left to its measured size.
    """
    one = entities.select("id", F.explode(ids("instance_of")).alias("qid")).join(flags, "qid")
    return one.groupBy("id").agg(
        F.bool_or("settlement").alias("hit"),
        F.bool_or("hard").alias("hard"),
        F.bool_or("soft").alias("soft"),
        F.bool_or("rescue").alias("rescue"),
        F.bool_and(F.when(F.col("settlement"), F.col("former"))).alias("all_former"),
        F.bool_or("not_a_place").alias("not_a_place"),
        F.bool_or("admin").alias("admin"),
    )


def gone() -> Column:
    """Dissolved or ended; any value counts."""
    filled = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    return filled("dissolved") | filled("end_time")


def settlement_test() -> Column:
    """The predicate over the columns of entity_flags; hard classes win, then dates, then former and soft ones."""
    on = lambda c: F.coalesce(F.col(c), F.lit(False))
    return (
        ~F.col("id").isin(*K.SANDBOX_ENTITIES)
        & ~on("hard")
        & on("hit")
        & ~gone()
        & ~on("all_former")
        & (~on("soft") | on("rescue"))
    )


def settlements(entities: DataFrame, flags: DataFrame) -> DataFrame:
    """The entities that ship as settlements."""
    return entities.join(entity_flags(entities, flags), "id", "left").filter(settlement_test()).select(entities.columns)


def has_class(classes: tuple[int, ...], column: str = "instance_of") -> Column:
    return F.arrays_overlap(ids(column), F.array(*[F.lit(int(c)).cast("long") for c in classes])) if classes else F.lit(False)


def excluded_division() -> Column:
    """A division that no longer exists, or a class that is about ISO codes."""
    return gone() | F.coalesce(has_class(K.ISO_ABOUT_CLASSES), F.lit(False))


def filled(column: str) -> Column:
    return F.coalesce(F.size(F.col(column)) > 0, F.lit(False))


def not_a_place(flag: Column) -> Column:
    """Classes that are no places, unless an ISO 3166-2 code says otherwise."""
    return ~filled("iso_3166_2") & F.coalesce(flag, F.lit(False))


def is_country() -> Column:
    return filled("iso_3166_1")
