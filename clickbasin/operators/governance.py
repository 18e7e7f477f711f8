"""Column filtering by sensitivity tag.

For cooperating users: Spark cannot stop anyone who may read the files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickbasin.schemas import PARTITION_KEYS, TAG_ASSIGNMENT
from clickbasin.session import small_frame

# The two tags, their values, and the default assignments.
LAYER = "layer"
SENSITIVITY = "sensitivity"
LAYERS = ["raw", "staging", "curated"]
SENSITIVITIES = ["public", "internal", "confidential"]
CONFIDENTIAL_COLUMNS = ["user_id", "session_id"]


@dataclass(frozen=True)
class Grant:
    """A column may be read when both of its tags are listed."""

    layers: tuple[str, ...]
    sensitivities: tuple[str, ...]
    privileges: tuple[str, ...]


ANALYST = Grant(("curated",), ("public", "internal"), ("SELECT", "DESCRIBE"))
ENGINEER = Grant(
    ("staging", "curated"),
    ("public", "internal", "confidential"),
    ("SELECT", "DESCRIBE", "INSERT", "ALTER"),
)


def default_assignments(
    spark: SparkSession,
    databases: dict[str, str],
    table: str = "events",
    confidential: Sequence[str] = CONFIDENTIAL_COLUMNS,
) -> DataFrame:
    """Layer tags on the databases, curated internal, its personal columns confidential."""
    rows = [(name, None, None, LAYER, layer) for layer, name in databases.items()]
    curated = databases["curated"]
    rows.append((curated, None, None, SENSITIVITY, "internal"))
    rows += [(curated, table, column, SENSITIVITY, "confidential") for column in confidential]
    return small_frame(spark, rows, TAG_ASSIGNMENT)


def columns_of(spark: SparkSession, database: str, table: str, schema: T.StructType) -> DataFrame:
    return small_frame(
        spark,
        [(database, table, name, at) for at, name in enumerate(schema.fieldNames())],
        "database string, table string, column string, position int",
    )


def resolve_tags(columns: DataFrame, assignments: DataFrame) -> DataFrame:
    """Every column's tags: its own, else its table's, else its database's."""
    target = columns.alias("c")
    tags = assignments.alias("t")
    applies = (
        (F.col("c.database") == F.col("t.database"))
        & (F.col("t.table").isNull() | (F.col("t.table") == F.col("c.table")))
        & (F.col("t.column").isNull() | (F.col("t.column") == F.col("c.column")))
    )
    closeness = F.col("t.table").isNotNull().cast("int") + F.col("t.column").isNotNull().cast("int")
    own = {key: F.col("t.tag") == key for key in (LAYER, SENSITIVITY)}
    return (
        target.join(tags, applies, "left")
        .groupBy("c.database", "c.table", "c.column", "c.position")
        .agg(
            *[
                F.max_by(F.col("t.tag_value"), F.when(is_key, closeness)).alias(key)
                for key, is_key in own.items()
            ]
        )
    )


def readable_columns(resolved: DataFrame, grant: Grant) -> list[str]:
    """The granted columns in table order: as many as the table has columns."""
    granted = resolved.where(
        F.col(LAYER).isin(list(grant.layers)) & F.col(SENSITIVITY).isin(list(grant.sensitivities))
    )
    return [row["column"] for row in granted.orderBy("position").select("column").collect()]


def governed(data: DataFrame, resolved: DataFrame, grant: Grant) -> DataFrame:
    """``data`` with the granted columns only; naming another one fails to resolve.

    The projection reaches the scan, so hidden columns are not even read.
    """
    columns = readable_columns(resolved, grant)
    if "SELECT" not in grant.privileges or not columns:
        raise PermissionError("the grant lets nobody read a column of this table")
    return data.select(*columns)


def governed_append(
    rows: DataFrame, resolved: DataFrame, grant: Grant, path: str, keys: Sequence[str] = PARTITION_KEYS
) -> None:
    """Append Parquet rows for a principal that may insert into every column of ``rows``."""
    hidden = set(rows.columns) - set(readable_columns(resolved, grant))
    if "INSERT" not in grant.privileges or hidden:
        raise PermissionError(f"the grant does not cover writing {sorted(hidden) or 'this table'}")
    rows.write.mode("append").option("compression", "snappy").partitionBy(*keys).parquet(path)
