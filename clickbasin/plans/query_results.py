"""Query results kept under the lake's fixed result folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickbasin.plans.paths import LakePaths


def save_result(result: DataFrame, lake: LakePaths, name: str, how: str = "parquet") -> str:
    """Write ``result`` as ``parquet`` or ``csv`` and return its path."""
    if how not in ("parquet", "csv"):
        raise ValueError("results are kept as parquet or csv")
    path = f"{lake.query_results}/{name}"
    writer = result.write.mode("overwrite")
    if how == "csv":
        writer = writer.option("header", True)
    writer.format(how).save(path)
    return path
