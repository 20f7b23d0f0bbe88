"""The employee dimension."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions import clean_text
from usagelens.schemas import EMPLOYEE_COLUMNS

# How exports commonly spell a missing value.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_employees(spark: SparkSession, path: str) -> DataFrame | None:
    """The dimension from a headered CSV, or None (with a warning) if there is no file.

    Quoted fields may hold doubled quotes, commas and line breaks; the usual spellings of a
    missing value are empty.
    """
    try:
        raw = spark.read.csv(path, header=True, escape='"', multiLine=True)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"{path} not found, enrichment will be skipped")
        return None
    texts = {c: F.when(~F.col(f"`{c}`").isin(MISSING_TEXTS), F.col(f"`{c}`")) for c in raw.columns}
    return conform_employees(raw.select(*[value.alias(c) for c, value in texts.items()]))


def conform_employees(raw: DataFrame) -> DataFrame:
    """Lower-case headers, trimmed text; missing columns only warn."""
    df = raw.toDF(*[c.strip().lower() for c in raw.columns])
    missing = sorted(set(EMPLOYEE_COLUMNS) - set(df.columns))
    if missing:
        warnings.warn(f"employee columns missing: {missing}; enrichment will be partial")
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: clean_text(F.col(c)) for c in text})


def duplicate_keys(employees: DataFrame) -> DataFrame:
    """Emails that occur more than once: each multiplies the events it matches."""
    return (employees.groupBy("email").agg(F.count("*").alias("copies"))
            .where(F.col("copies") > 1))
