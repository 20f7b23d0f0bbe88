"""Actions given to Spark together."""

import threading

import pytest

from usagelens.plans import tables
from usagelens.session import side_by_side


def test_statistics_of_all_tables_are_gathered_together(spark, tmp_path, monkeypatch):
    """Each waits for the others; one after the other none would end."""
    names = [*tables.TABLE_NAMES, tables.REQUEST_KEYS]
    for name in names:
        spark.range(1).write.parquet(tables.table_path(str(tmp_path), name))
    others, analyzed = threading.Barrier(len(names)), []

    def analyze(session, table):
        others.wait(60)
        analyzed.append(table)

    monkeypatch.setattr(tables, "_analyze", analyze)
    tables.add_to_catalog(spark, str(tmp_path), "together")
    assert sorted(analyzed) == sorted(f"together.{name}" for name in names)


def test_results_keep_their_order_and_failures_are_raised(spark):
    assert side_by_side(spark, lambda: spark.range(3).count(), lambda: 5) == [3, 5]
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, lambda: 1, lambda: 1 / 0)
