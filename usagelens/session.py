"""Session settings and the shared folder for tables written between stages."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Settings for a session of one's own: times shown in UTC, skewed joins split. The
    package itself leaves the caller's settings alone and does not depend on the zone.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def staging_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, and where none is named a folder of the
    warehouse, which executors share as well. The session's settings stay as they are."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"


def _application_folder(spark: SparkSession) -> str:
    return f"{staging_folder(spark)}/usagelens-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result has a short lineage that survives lost executors, and the columns
    a later stage does not need are not read again. The files stay until
    ``remove_staged``, because the returned plan reads them.
    """
    path = path or new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, *actions: Callable) -> list:
    """What some actions that do not need each other return. They are given to Spark together,
    so that tasks of one take the cores that the last tasks of another leave idle."""
    with ThreadPoolExecutor(len(actions)) as pool:
        return [x.result() for x in [pool.submit(inheritable_thread_target(spark)(a)) for a in actions]]


def remove_staged(spark: SparkSession, path: str | None = None) -> None:
    """Delete one staged path, or all that this application has staged."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path or _application_folder(spark))
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(target):
        files.delete(target, True)
