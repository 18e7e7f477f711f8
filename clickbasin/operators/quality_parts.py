"""Quality measures that late rows are added to, without measuring the others again.

Every drop of rows leaves its sums, and the numbers of copies of its ids, by day and bucket of the id. Sums add up.
Whether an id is unique depends on all drops, so the buckets that a drop has ids in are counted again, from the
stored copies of these buckets alone; the counts of the other buckets stand. ``measures`` merges both into the
columns of ``quality.measure``, for ``quality.constraint_results``.

The measures depend on the allowed event types, and buckets on their number: use a root for each choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickbasin.operators.quality import QualityRules, totals
from clickbasin.schemas import DATE_KEYS

BUCKETS = 64
# What is stored: sums by drop, copies by bucket and drop, counts of a bucket as of a drop.
SUMS, COPIES, COUNTS = "sums", "copies", "counts"


def _replace(frame: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("drop", T.IntegerType())])).parquet(path)


def add_drop(events: DataFrame, root: str, drop: int, rules: QualityRules, buckets: int = BUCKETS) -> None:
    """Take in the rows of a drop. Drops are numbered upwards; one that is taken in again replaces itself."""
    spark = events.sparkSession
    _replace(totals(events, rules, DATE_KEYS), f"{root}/{SUMS}/drop={drop}")
    bucket = F.pmod(F.xxhash64("event_id"), F.lit(buckets)).cast("int").alias("bucket")
    # Copies are summed in the map tasks: an id that holds much of the rows is one row a task.
    copies = events.where(F.col("event_id").isNotNull()).groupBy(*DATE_KEYS, bucket, "event_id").agg(F.count(F.lit(1)).alias("copies"))
    _replace(copies.hint("rebalance", *DATE_KEYS, "bucket"), f"{root}/{COPIES}/drop={drop}", [*DATE_KEYS, "bucket"])

    touched = spark.read.schema(copies.schema).parquet(f"{root}/{COPIES}/drop={drop}").select(*DATE_KEYS, "bucket").distinct()
    stored = _stored(spark, f"{root}/{COPIES}", copies.schema).where(F.col("drop") <= drop)
    # A row a day of the drop and bucket at most; Spark prunes the other folders by them at run time.
    again = stored.join(F.broadcast(touched), [*DATE_KEYS, "bucket"], "left_semi")
    ids = again.groupBy(*DATE_KEYS, "bucket", "event_id").agg(F.sum("copies").alias("copies"))
    counts = ids.groupBy(*DATE_KEYS, "bucket").agg(
        F.sum("copies").alias("event_id_present"), F.count_if(F.col("copies") == 1).alias("single_event_ids")
    )
    _replace(counts, f"{root}/{COUNTS}/drop={drop}")


def measures(spark: SparkSession, root: str) -> DataFrame:
    """A row of measurements a day, over all drops: a few numbers a drop and a bucket are read, no event."""
    sums = _stored(spark, f"{root}/{SUMS}", spark.read.parquet(f"{root}/{SUMS}").drop("drop").schema)
    added = {name: F.max(name) if name.startswith("max_") else F.sum(name) for name in sums.columns if name not in [*DATE_KEYS, "drop"]}
    whole = sums.groupBy(*DATE_KEYS).agg(*[value.alias(name) for name, value in added.items()])
    # A bucket's counts are those of the last drop that touched it.
    names = ["event_id_present", "single_event_ids"]
    stored = _stored(spark, f"{root}/{COUNTS}", spark.read.parquet(f"{root}/{COUNTS}").drop("drop").schema)
    counts = stored.groupBy(*DATE_KEYS, "bucket").agg(
        *[F.max_by(name, "drop").alias(name) for name in names]
    )
    ids = counts.groupBy(*DATE_KEYS).agg(*[F.sum(name).alias(name) for name in names])
    merged = whole.unionByName(ids, allowMissingColumns=True).groupBy(*DATE_KEYS)
    return merged.agg(
        *[F.max(name).alias(name) for name in added], *[F.coalesce(F.max(name), F.lit(0)).alias(name) for name in names]
    )
