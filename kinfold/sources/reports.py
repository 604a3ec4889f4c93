"""Reports: one JSON object a folder, from frames of one row and plain values."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def row_values(df: DataFrame) -> dict:
    """A one-row frame's values by column; an empty frame's are none."""
    row = df.first()
    return row.asDict(recursive=True) if row else {}


def write_report(spark: SparkSession, path: str, values: dict, overwrite: bool = False) -> None:
    """The values as one line of JSON, through Spark's file systems; a report that exists stays unless it is to be overwritten."""
    line = json.dumps(values, sort_keys=True, default=float)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def read_report(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first().value)
