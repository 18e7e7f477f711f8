"""The dashboard's dataset and its four aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickbasin.functions.dates import IngestDay
from clickbasin.operators.money import total
from clickbasin.operators.ranking import top_n_and_other
from clickbasin.schemas import CURATED, DATE_KEYS, PARTITION_KEYS
from clickbasin.sources import versions
from clickbasin.sources.curated import read_curated, read_curated_day
from clickbasin.sources.storage import delete, exists, partition_folders, replace_day

# Fixed value: bars shown before the remainder is folded.
CATEGORY_LIMIT = 20


def bi_dataset(curated: DataFrame) -> DataFrame:
    """The 14 typed columns plus the calendar day of the event time.

    ``value`` stays double: "decimal" is the dashboard's word for any number
    with a fraction, and a fixed scale would round.
    """
    return curated.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in CURATED.fields],
        F.date_trunc("DAY", "event_ts").alias("event_date"),
    )


def kpi_total_events(dataset: DataFrame) -> DataFrame:
    return dataset.agg(F.count("event_id").alias("total_events"))


def kpi_total_value(dataset: DataFrame) -> DataFrame:
    """Sum over all event types, hence more than the purchase revenue."""
    return dataset.agg(total("value").alias("total_value"))


def events_by_type(dataset: DataFrame, n: int = CATEGORY_LIMIT) -> DataFrame:
    counts = dataset.groupBy("event_type").agg(F.count("event_id").alias("events"))
    return top_n_and_other(counts, "event_type", "events", n)


def daily_event_volume(dataset: DataFrame) -> DataFrame:
    return (
        dataset.groupBy(F.date_trunc("DAY", "event_ts").alias("event_day"))
        .agg(F.count("event_id").alias("events"))
        .orderBy("event_day")
    )


def _write(dataset: DataFrame, path: str) -> None:
    """A plain copy: the curated files are well sized already, so nothing is shuffled."""
    (
        dataset.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*PARTITION_KEYS)
        .parquet(path)
    )


def refresh_dataset(
    spark: SparkSession, curated_root: str, dataset_root: str, day: IngestDay | None = None
) -> bool:
    """Bring the stored dataset up to date; False when there is no curated table.

    Without ``day`` everything is rebuilt. With ``day`` only that day's
    partitions are replaced, which gives the same table when no other day
    changed and does not copy the whole history every night. Either way the
    dataset stays readable until its new files are complete.
    """
    whole = day is None or not exists(spark, dataset_root)
    curated = read_curated(spark, curated_root) if whole else read_curated_day(spark, curated_root, day)
    if curated is None:
        return False
    if whole:
        if versions.is_versioned(spark, dataset_root):
            days = curated.select(*DATE_KEYS).distinct().collect()  # a row a day
            held = {IngestDay(*row) for row in days} | set(versions.live_versions(spark, dataset_root))
            versions.replace_days(spark, dataset_root, sorted(held), lambda path: _write(bi_dataset(curated), path))
            return True
        _write(bi_dataset(curated), dataset_root)
        # Curated has a folder for every partition that has rows; others in the dataset are leftovers.
        wanted = partition_folders(spark, curated_root)
        for folder in sorted(partition_folders(spark, dataset_root) - wanted):
            delete(spark, f"{dataset_root.rstrip('/')}/{folder}")
    else:
        replace_day(spark, dataset_root, day, lambda path: _write(bi_dataset(curated), path))
    return True


def read_dataset(spark: SparkSession, root: str) -> DataFrame | None:
    """The stored dataset, or ``None`` before its first refresh."""
    if not exists(spark, root):
        return None
    schema = T.StructType([*CURATED.fields, T.StructField("event_date", T.TimestampType())])
    if versions.is_versioned(spark, root):
        return versions.read_versions(spark, root, schema, versions.live_versions(spark, root))
    return spark.read.schema(schema).parquet(root)


def dataset_view(spark: SparkSession, curated_root: str, name: str) -> None:
    """The direct-query alternative: a view over curated instead of a copy."""
    curated = read_curated(spark, curated_root)
    if curated is None:
        raise FileNotFoundError(curated_root)
    bi_dataset(curated).createOrReplaceTempView(name)


def export_csv(result: DataFrame, path: str) -> None:
    """Write the rows behind a visual as CSV with a header."""
    result.write.mode("overwrite").option("header", True).csv(path)
