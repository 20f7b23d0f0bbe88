"""The five curated tables, built lazily or read from where they were saved."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, lru_cache, partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.operators import marts
from usagelens.operators.enrich import SENT_PRACTICE, enrich
from usagelens.operators.standardize import standardize
from usagelens.session import side_by_side, stage


TABLE_NAMES = ["events", "api_requests", "tool_results", "sessions", "users"]
#: Saved beside the tables: sessions and users by practice and model of their requests.
REQUEST_KEYS = "request_keys"


class Curated:
    """The five tables. Each is given as a function and only planned when asked for:
    a query over one of them does not pay for describing the other four.

    ``request_keys``, which model filters look up, may be given as well; else it is
    found among the requests.
    """

    def __init__(self, **makers: Callable[[], DataFrame]):
        self._makers = {name: makers[name] for name in [*TABLE_NAMES, REQUEST_KEYS]
                        if name in makers or name in TABLE_NAMES}

    @cached_property
    def events(self) -> DataFrame:
        return self._makers["events"]()

    @cached_property
    def api_requests(self) -> DataFrame:
        return self._makers["api_requests"]()

    @cached_property
    def tool_results(self) -> DataFrame:
        return self._makers["tool_results"]()

    @cached_property
    def sessions(self) -> DataFrame:
        return self._makers["sessions"]()

    @cached_property
    def users(self) -> DataFrame:
        return self._makers["users"]()

    @cached_property
    def request_keys(self) -> DataFrame:
        if REQUEST_KEYS in self._makers:
            return self._makers[REQUEST_KEYS]()
        return self.api_requests.select("session_id", "user_id", "practice", "model").distinct()

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in TABLE_NAMES]

    def change(self, **rules: Callable[[DataFrame], DataFrame]) -> "Curated":
        """The same tables with a rule applied to each named one."""
        def changed(name: str) -> Callable[[], DataFrame]:
            if name not in rules:
                return lambda: getattr(self, name)
            return lambda: rules[name](getattr(self, name))

        return Curated(**{name: changed(name) for name in [*TABLE_NAMES, REQUEST_KEYS]})

    def map(self, rule: Callable[[DataFrame], DataFrame]) -> "Curated":
        return self.change(**{name: rule for name in [*TABLE_NAMES, REQUEST_KEYS]})

    def persist(self) -> "Curated":
        """Keep the tables for interactive use; Spark spills what does not fit."""
        return self.map(lambda df: df.persist())

    def unpersist(self) -> None:
        """Give back what ``persist`` holds."""
        for df in [*dict(self.items()).values(), self.request_keys]:
            df.unpersist()


def curate(events: DataFrame) -> Curated:
    """Curated tables from enriched events. Sessions and users share one ``activity``, which
    is written to the shared folder when one of them is first asked for."""
    plain = events.drop(SENT_PRACTICE)
    rows = lru_cache(maxsize=1)(lambda: stage(marts.activity(events), "activity"))
    tables = Curated(
        events=lambda: plain,
        api_requests=lambda: marts.api_requests(plain),
        tool_results=lambda: marts.tool_results(plain),
        sessions=lambda: marts.sessions_of(rows()),
        users=lambda: marts.users_of(rows(), tables.sessions),
    )
    return tables


def build_tables(raw: DataFrame, employees: DataFrame | None) -> Curated:
    """Everything from raw events, planned on demand, without event numbers."""
    return curate(enrich(standardize(raw), employees, keep_sent_practice=True))


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def read_tables(spark: SparkSession, folder: str) -> Curated:
    def reader(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.parquet(table_path(folder, name))

    return Curated(**{name: reader(name) for name in [*TABLE_NAMES, REQUEST_KEYS]})


def register_tables(tables: Curated) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def save_as_tables(tables: Curated, database: str, folder: str | None = None) -> None:
    """Save into the catalog and gather column statistics for the optimizer."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        if folder:
            writer = writer.option("path", table_path(folder, name))
        writer.saveAsTable(f"{database}.{name}")
        _analyze(df.sparkSession, f"{database}.{name}")


def _analyze(spark: SparkSession, table: str) -> None:
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def listed_sessions(tables: Curated) -> DataFrame:
    """Sessions as shown: by their start, those without a time last. Saved tables are not
    sorted, only what is shown is."""
    return tables.sessions.orderBy(F.asc_nulls_last("session_start"), "session_id")


def listed_users(tables: Curated) -> DataFrame:
    """Users as shown: by practice, those with most tokens first."""
    return tables.users.orderBy("practice", F.desc("total_tokens"), "user_id")


def add_to_catalog(spark: SparkSession, folder: str, database: str) -> Curated:
    """Name the tables a run has saved in the catalog, where they lie, and gather their
    column statistics. The tables returned are read through the catalog, so the optimizer
    plans with these statistics; nothing is copied."""
    names = [*TABLE_NAMES, REQUEST_KEYS]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        # An unmanaged table: dropping it leaves the files.
        spark.catalog.createTable(f"{database}.{name}", table_path(folder, name), "parquet")
        if any(c.isPartition for c in spark.catalog.listColumns(f"{database}.{name}")):
            spark.catalog.recoverPartitions(f"{database}.{name}")
    side_by_side(spark, *[partial(_analyze, spark, f"{database}.{name}") for name in names])
    return catalog_tables(spark, database)


def catalog_tables(spark: SparkSession, database: str) -> Curated:
    def reader(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.table(f"{database}.{name}")

    return Curated(**{name: reader(name) for name in [*TABLE_NAMES, REQUEST_KEYS]})


def column_statistics(spark: SparkSession, database: str, table: str, column: str) -> DataFrame:
    """One row of what the catalog has gathered about a column."""
    known = spark.sql(f"DESCRIBE EXTENDED {database}.{table} {column}")
    return known.agg(*[F.max(F.when(F.col("info_name") == name, F.col("info_value"))).alias(label)
                       for name, label in (("min", "least"), ("max", "greatest"), ("num_nulls", "nulls"))]
                     ).select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "*")


def table_counts(tables: Curated) -> DataFrame:
    parts = [df.agg(F.count("*").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def run_totals(tables: Curated) -> DataFrame:
    """Time range, tokens and cost over all events (the overview sums requests only)."""
    return tables.events.agg(
        F.min("timestamp").alias("first_event_at"),
        F.max("timestamp").alias("last_event_at"),
        F.coalesce(F.sum("total_tokens"), F.lit(0.0)).alias("total_tokens"),
        F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("total_cost_usd"),
    )
