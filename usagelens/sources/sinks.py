"""Writers for tables, the report and the view exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from usagelens.sources.logs import OUTCOME
from usagelens.plans.tables import Curated, table_path
from usagelens.plans.views import VIEWS


def write_raw_events(raw: DataFrame, path: str) -> None:
    raw.write.mode("overwrite").parquet(path)


def write_decoded(decoded: DataFrame, path: str) -> DataFrame:
    """Write what a lenient read found, events and rejects in folders of their own, and
    return it as read back. The logs are read once for both."""
    decoded.write.mode("overwrite").partitionBy(OUTCOME).parquet(path)
    columns = [f for f in decoded.schema.fields if f.name != OUTCOME]
    outcome = [T.StructField(OUTCOME, T.StringType())]
    return decoded.sparkSession.read.schema(T.StructType(columns + outcome)).parquet(path)


def write_table(df: DataFrame, folder: str, name: str,
                partition_by: str | None = None) -> DataFrame:
    """Write one curated table and return it as read back."""
    path = table_path(folder, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """The one-row report as a JSON object."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").option(
        "timeZone", "UTC").json(path)


def export_views(tables: Curated, folder: str) -> None:
    """Every view as headered CSV, the overview as JSON too.

    The overview is one row and one file. Other views are as long as there are models, tools
    and the like, which senders choose, so they are written by as many tasks as they need.
    Times are in UTC; whole numbers stay whole in the JSON.
    """
    for name in VIEWS:
        export_view(tables, name, folder)


def export_view(tables: Curated, name: str, folder: str) -> None:
    """One view, as ``export_views`` writes it."""
    df = VIEWS[name](tables)
    df.write.mode("overwrite").option("timeZone", "UTC").csv(table_path(folder, name), header=True)
    if name == "overview":
        df.coalesce(1).write.mode("overwrite").json(table_path(folder, "overview_json"))
