"""Consecutive event numbers without funnelling the events through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.schemas import EVENT_ORDER
from usagelens.session import stage

# monotonically_increasing_id: partition number above these bits, position below.
_POSITION_BITS = 33


def number_rows(df: DataFrame, order: list[str], name: str,
                partitions: int | None = None, path: str | None = None) -> DataFrame:
    """Add ``name``, 1..N in the given order with nulls last.

    Rows are range-partitioned and sorted, so a partition number and a position
    inside the partition place every row. They are written to the shared folder
    before any counting: range limits come from a sample, and a second run could
    draw others. The number is then the position plus the row count of the earlier
    partitions, a table of one row per partition. Calling this runs the write; the rows
    stay where they were written (``path``, or a new one) as long as the result is in use.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    ranged = (df.repartitionByRange(partitions, *keys) if partitions
              else df.repartitionByRange(*keys))
    placed = (ranged.sortWithinPartitions(*keys)
              .withColumn("_slot", F.monotonically_increasing_id()))
    placed = stage(placed, name, path)

    part = F.shiftright("_slot", _POSITION_BITS).alias("_part")
    position = F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    sizes = placed.groupBy(part).agg(F.count("*").alias("_rows"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))

    # One row of two numbers per range partition: safe to broadcast at any data size.
    return (placed.withColumn("_part", part)
            .join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + position + 1)
            .drop("_part", "_slot", "_before"))


def number_events(events: DataFrame, partitions: int | None = None,
                  path: str | None = None) -> DataFrame:
    """Add ``event_id`` in (timestamp, session, event name) order.

    De-duplicated rows differ somewhere, and the whole row is the sort key, so even a
    timestamp or session that holds much of the data splits over range partitions.
    Best called on ``clean`` events: derived columns are cheaper to compute afterwards
    than to shuffle and write.
    """
    extra = [c for c in events.columns if c not in EVENT_ORDER]
    return number_rows(events, [*EVENT_ORDER, *extra], "event_id", partitions, path)
