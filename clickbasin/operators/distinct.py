"""Exact distinct counts that add up over days: sets of numbered members.

Members get whole numbers from a dictionary that only grows. A set is kept in parts of ``PART`` numbers, each
either a short list of places or a bitmap, whichever is smaller; sets of several days are united part by part
with the bitmap functions, and counted without looking at a single event again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickbasin.session import small_frame
from clickbasin.sources.storage import exists

# Fixed value: numbers that one of Spark's bitmaps holds.
PART = 32_768
# Places listed by themselves up to so many, two bytes each; a bitmap takes four kilobytes.
LISTED = 1_000
# The dictionary is cut by a hash of the member; numbers go round the cuts, so that they stay dense.
CUTS = 64

DICTIONARY = T.StructType(
    [T.StructField("member", T.StringType()), T.StructField("number", T.LongType()), T.StructField("cut", T.IntegerType())]
)


def _cut(member: Column) -> Column:
    return F.pmod(F.xxhash64(member), F.lit(CUTS)).cast("int")


def read_dictionary(spark: SparkSession, root: str) -> DataFrame:
    if not exists(spark, root):
        return small_frame(spark, [], DICTIONARY)
    return spark.read.schema(DICTIONARY).parquet(root)


def number_members(members: DataFrame, root: str) -> None:
    """Give each ``member`` (a column of text) that has no number yet the next ones of its cut.

    Numbers are never changed or used again. New ones begin behind the largest there is, so that what an
    unfinished run left behind does no harm. One writer at a time.
    """
    spark = members.sparkSession
    known = read_dictionary(spark, root)
    new = (
        members.where(F.col("member").isNotNull())
        .distinct()
        .withColumn("cut", _cut(F.col("member")))
        .join(known.select("member", "cut"), ["member", "cut"], "left_anti")
    )
    # A row for each cut.
    last = known.groupBy("cut").agg(F.max("number").alias("last"))
    order = Window.partitionBy("cut").orderBy("member")
    numbered = new.withColumn("place", F.row_number().over(order)).join(last, "cut", "left")
    before = F.coalesce(F.floor((F.col("last") - F.col("cut")) / CUTS) + 1, F.lit(0))
    number = (F.col("cut") + CUTS * (before + F.col("place") - 1)).cast("long")
    numbered.select("member", number.alias("number"), "cut").write.mode("append").partitionBy("cut").parquet(root)


def sets(rows: DataFrame, keys: Sequence[str], member: str, dictionary: DataFrame) -> DataFrame:
    """``keys, part, places, bits``: the set of members of each group, null members left out.

    Every member has to be in the dictionary. Copies of a member go in the map tasks, before it is looked up.
    """
    pairs = rows.where(F.col(member).isNotNull()).select(*keys, F.col(member).alias("member")).distinct()
    numbered = pairs.withColumn("cut", _cut(F.col("member"))).join(dictionary, ["member", "cut"])
    # Spark's bitmap functions count from 1.
    at = F.col("number") + 1
    placed = numbered.select(*keys, F.bitmap_bucket_number(at).alias("part"), F.bitmap_bit_position(at).alias("place"))
    grouped = placed.groupBy(*keys, "part").agg(
        F.bitmap_construct_agg("place").alias("bits"), F.collect_list(F.col("place").cast("smallint")).alias("places")
    )
    short = F.size("places") <= LISTED
    return grouped.select(*keys, "part", F.when(short, F.col("places")).alias("places"), F.when(~short, F.col("bits")).alias("bits"))


def count_members(found: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``keys, name``: how many members the united sets of each group have."""
    listed = (
        found.where(F.col("places").isNotNull())
        .select(*keys, "part", F.explode("places").alias("place"))
        .groupBy(*keys, "part")
        .agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits"))
    )
    mapped = found.where(F.col("bits").isNotNull()).select(*keys, "part", "bits")
    united = listed.unionByName(mapped).groupBy(*keys, "part").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return united.groupBy(*keys).agg(F.sum("n").alias(name))
