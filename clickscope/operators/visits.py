"""User-visit filter: the shared input of the category and page reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import VisitParams
from ..plans.joins import bounded_broadcast


def _present(v) -> bool:
    return v is not None and not (isinstance(v, str) and v.strip() == "")


def visit_predicate(p: VisitParams) -> Column:
    """Fold the optional bounds into one predicate (dates compare as ISO text)."""
    conds: list[Column] = []
    if _present(p.start_date):
        conds.append(F.col("date") >= F.lit(p.start_date))
    if _present(p.end_date):
        conds.append(F.col("date") <= F.lit(p.end_date))
    if _present(p.start_age):
        conds.append(F.col("age") >= F.lit(int(p.start_age)))
    if _present(p.end_age):
        bound = F.lit(int(p.end_age))
        conds.append(F.col("age") >= bound if p.as_written else F.col("age") <= bound)
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def user_visit_filter(uva: DataFrame, user_info: DataFrame, p: VisitParams) -> DataFrame:
    """Visits of known users inside the date and age bounds, with ``age`` added.

    The age bounds reach the user scan, so the join sees only qualifying
    users; the user dimension is broadcast after a bounded size check.
    """
    users = user_info.select("user_id", "age")
    return uva.join(bounded_broadcast(users), "user_id").where(visit_predicate(p))
