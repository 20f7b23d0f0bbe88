"""Employee attributes on events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions import or_unknown
from usagelens.schemas import EMPLOYEE_COLUMNS, UNKNOWN

_ATTRIBUTES = ["full_name", "level", "location"]
#: The practice an event was sent with, kept beside the resolved one because it is
#: part of the event order.
SENT_PRACTICE = "practice_resource"


def is_small(employees: DataFrame) -> bool:
    """Whether Spark's estimate of the list is below its broadcast threshold, so that
    events joined with it stay where they are."""
    threshold = employees.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = employees._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size) <= threshold


def enrich(events: DataFrame, employees: DataFrame | None,
           keep_sent_practice: bool = False) -> DataFrame:
    """Left join on email, then settle practice, name, level and location.

    ``employees`` come from ``read_employees`` or ``conform_employees``.

    The employee's practice wins wherever an employee matched, even a blank one;
    the practice sent with the event only serves unmatched events. Blank becomes
    ``Unknown``. No join hint: Spark broadcasts the dimension when its size is under
    the threshold, and otherwise runs a shuffled join that splits skewed emails.
    """
    sent = events.withColumnRenamed("practice", SENT_PRACTICE)
    if employees is None:
        joined = sent.withColumns({c: F.lit(UNKNOWN) for c in _ATTRIBUTES})
        practice = F.col(SENT_PRACTICE)
    else:
        # Further columns of the list come along unless events have one of that name.
        dim = employees.select(*[c for c in employees.columns
                                 if c in EMPLOYEE_COLUMNS or c not in sent.columns])
        practice = F.col(SENT_PRACTICE)
        if "practice" in dim.columns:
            dim = dim.withColumnRenamed("practice", "_practice")
            practice = F.coalesce("_practice", SENT_PRACTICE)
        joined = sent.join(dim, "email", "left")
        joined = joined.withColumns({
            c: or_unknown(F.col(c)) if c in dim.columns else F.lit(UNKNOWN)
            for c in _ATTRIBUTES
        })
    resolved = joined.withColumn("practice", or_unknown(practice))
    drop = ["_practice"] if keep_sent_practice else ["_practice", SENT_PRACTICE]
    return resolved.drop(*drop)
