"""Pre-aggregates joined into the shipment star.

* ``child_total``: SUM of a child measure per parent through a left join.
* ``distinct_legs``: unique (route, from, to) legs with their text leg code.
* ``route_lead_time``: SUM of service-leg times per route over distinct legs.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import leg_code


def child_total(
    links: DataFrame,
    children: DataFrame,
    parent_key: str,
    link: str,
    child_key: str,
    measure: str,
    out: str,
) -> DataFrame:
    """``SUM(children.measure)`` per ``links.parent_key`` via ``link = child_key``.

    Parents whose children are all missing keep a row with NULL. Children
    are unique by ``child_key`` (latest versions), so the join cannot fan
    out; the aggregate combines map-side before its shuffle.
    """
    c = children.select(F.col(child_key).alias("__ck"), F.col(measure).alias("__m"))
    joined = links.select(parent_key, link).join(c, F.col(link) == F.col("__ck"), "left")
    return joined.groupBy(parent_key).agg(F.sum("__m").alias(out))


def distinct_legs(
    route_legs: DataFrame,
    route: str = "route",
    start: str = "knanf",
    end: str = "knend",
    out: str = "sap_leg_code",
) -> DataFrame:
    """Unique (route, start, end) with the composite leg code."""
    return (
        route_legs.select(route, start, end)
        .distinct()
        .withColumn(out, leg_code(start, end))
    )


def route_lead_time(
    legs: DataFrame,
    service_legs: DataFrame,
    route: str = "route",
    leg: str = "sap_leg_code",
    code: str = "code",
    time: str = "transportation_time",
    out: str = "svt_route_lead_time",
) -> DataFrame:
    """``SUM(time)`` per route over its distinct legs joined to service legs by code.

    A code may occur on several service legs; every match counts. The
    service legs are summed per code *before* the join (sum distributes over
    the matches), so a repeated or hot code costs one row instead of a
    many-to-many fan-out.
    """
    per_code = service_legs.groupBy(F.col(code).alias("__code")).agg(F.sum(time).alias("__t"))
    joined = legs.select(route, leg).join(per_code, F.col(leg) == F.col("__code"), "left")
    return joined.groupBy(route).agg(F.sum("__t").alias(out))
