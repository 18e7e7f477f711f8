"""Reports and dashboard figures from what each curated day adds to them.

A day's totals are small and only depend on that day's partitions, so a day that arrives, or is curated again,
rewrites its own totals and nothing else; reports then read totals instead of events. Sums and counts are
additive. Distinct users and sessions are kept as sets, see ``operators.distinct``.

Each function gives the rows of its namesake in ``plans.reports`` or ``plans.dashboard``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickbasin.functions.dates import IngestDay, clock
from clickbasin.operators.distinct import count_members, number_members, read_dictionary, sets
from clickbasin.operators.money import AMOUNT
from clickbasin.operators.ranking import top_n_and_other
from clickbasin.plans.dashboard import CATEGORY_LIMIT
from clickbasin.plans.paths import LakePaths
from clickbasin.plans.reports import LIST_LENGTH, PURCHASE, SALES_TYPES, SEARCH
from clickbasin.schemas import DATE_KEYS
from clickbasin.session import pin
from clickbasin.sources.curated import read_curated, read_curated_day
from clickbasin.sources.storage import day_folders, delete, exists

# Additive: by type, country and hour; by type and article; by search term.
EVENTS, SKUS, SEARCHES = "events", "skus", "searches"
# Sets: a day's users and sessions, users by country, sessions by search term.
USERS, SESSIONS, COUNTRY_USERS, SEARCH_SESSIONS = "users", "sessions", "country-users", "search-sessions"


def _event_totals(curated: DataFrame, keys: Sequence[str]) -> DataFrame:
    amount = F.col("value").try_cast(AMOUNT)
    return curated.groupBy(*keys, "event_type", "country", F.date_trunc("hour", "event_ts").alias("event_hour")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("event_id").alias("events"),
        F.sum(amount).alias("value"),
        F.count(amount).alias("values"),
        F.max("processed_at").alias("processed_at"),
    )


def _sku_totals(curated: DataFrame, keys: Sequence[str]) -> DataFrame:
    sold = curated.where(F.col("event_type").isin(SALES_TYPES) & F.col("sku").isNotNull())
    return sold.groupBy(*keys, "sku").agg(F.sum("quantity").alias("units"), F.count(F.lit(1)).alias("line_items"))


def _searches(curated: DataFrame) -> DataFrame:
    asked = (F.col("event_type") == SEARCH) & F.col("query").isNotNull() & (F.col("query") != "")
    return curated.where(asked).withColumn("search_term", F.lower("query"))


def _search_totals(curated: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _searches(curated).groupBy(*keys, "search_term").agg(F.count(F.lit(1)).alias("searches"))


def _folder(lake: LakePaths, name: str) -> str:
    return f"{lake.totals}/{name}"


def _dictionary(lake: LakePaths, kind: str) -> str:
    return f"{lake.distinct}/{kind}"


def _write(frame: DataFrame, root: str, day: IngestDay | None) -> None:
    """All days, or the folder of one, which then holds these rows only."""
    if day is not None:
        frame.write.mode("overwrite").parquet(f"{root}/{day.folder()}")
        return
    rows = frame.hint("rebalance", *DATE_KEYS)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*DATE_KEYS).parquet(root)


def refresh_totals(spark: SparkSession, lake: LakePaths, day: IngestDay | None = None) -> bool:
    """Bring the totals of a day, or of all days, in line with curated; False when there is no curated table.

    A day without curated rows has no totals afterwards. Nothing of other days is read or written but the
    dictionaries of users and sessions, which new members are added to.
    """
    pin(spark)
    curated = read_curated(spark, lake.curated) if day is None else read_curated_day(spark, lake.curated, day)
    if curated is None:
        return False
    if day is not None and not day_folders(spark, lake.curated, day):
        for name in (EVENTS, SKUS, SEARCHES, USERS, SESSIONS, COUNTRY_USERS, SEARCH_SESSIONS):
            delete(spark, f"{_folder(lake, name)}/{day.folder()}")
        return True
    keys = DATE_KEYS if day is None else []
    for name, totals in ((EVENTS, _event_totals), (SKUS, _sku_totals), (SEARCHES, _search_totals)):
        _write(totals(curated, keys), _folder(lake, name), day)

    for member in ("user_id", "session_id"):
        number_members(curated.select(F.col(member).alias("member")), _dictionary(lake, member))
    users, sessions = (read_dictionary(spark, _dictionary(lake, member)) for member in ("user_id", "session_id"))
    known = curated.where(F.col("user_id").isNotNull())
    located = known.where(F.col("country").isNotNull())
    for name, found in (
        (USERS, sets(known, keys, "user_id", users)),
        (SESSIONS, sets(known, keys, "session_id", sessions)),
        (COUNTRY_USERS, sets(located, [*keys, "country"], "user_id", users)),
        (SEARCH_SESSIONS, sets(_searches(curated), [*keys, "search_term"], "session_id", sessions)),
    ):
        _write(found, _folder(lake, name), day)
    return True


def _read(spark: SparkSession, lake: LakePaths, name: str) -> DataFrame:
    if not exists(spark, _folder(lake, name)):
        raise FileNotFoundError(f"no totals below {lake.totals}; see refresh_totals")
    return pin(spark).read.parquet(_folder(lake, name))


def _newest_days() -> list[Column]:
    return [F.desc(name) for name in DATE_KEYS]


def _money(name: str) -> Column:
    return F.sum(name).cast("double")


def daily_event_counts(spark: SparkSession, lake: LakePaths) -> DataFrame:
    totals = _read(spark, lake, EVENTS).groupBy(*DATE_KEYS, "event_type").agg(F.sum("rows").alias("events"))
    return totals.orderBy(*_newest_days(), F.desc("events"), "event_type")


def revenue_by_date(spark: SparkSession, lake: LakePaths) -> DataFrame:
    bought = _read(spark, lake, EVENTS).where(F.col("event_type") == PURCHASE)
    # Twelve digits, as the mean of the amounts themselves has.
    mean = F.try_divide(F.sum("value").cast("decimal(38,12)"), F.sum("values").cast("decimal(20,0)")).cast("double")
    totals = bought.groupBy(*DATE_KEYS).agg(
        F.sum("rows").alias("purchases"), _money("value").alias("revenue"), mean.alias("avg_order_value")
    )
    return totals.orderBy(*_newest_days())


def top_skus_by_quantity(spark: SparkSession, lake: LakePaths, k: int = LIST_LENGTH) -> DataFrame:
    totals = _read(spark, lake, SKUS).groupBy("sku").agg(F.sum("units").alias("units"), F.sum("line_items").alias("line_items"))
    return totals.orderBy(F.desc_nulls_last("units"), "sku").limit(k)


def top_search_queries(spark: SparkSession, lake: LakePaths, k: int = LIST_LENGTH) -> DataFrame:
    """The most frequent terms are found first, and sets united for these only."""
    searches = _read(spark, lake, SEARCHES).groupBy("search_term").agg(F.sum("searches").alias("searches"))
    top = searches.orderBy(F.desc("searches"), "search_term").limit(k)
    asked = _read(spark, lake, SEARCH_SESSIONS).join(top.select("search_term"), "search_term", "left_semi")
    found = top.join(count_members(asked, ["search_term"], "sessions"), "search_term", "left")
    return found.select("search_term", "searches", F.coalesce("sessions", F.lit(0)).alias("sessions")).orderBy(F.desc("searches"), "search_term")


def daily_active_users(spark: SparkSession, lake: LakePaths) -> DataFrame:
    users = count_members(_read(spark, lake, USERS), DATE_KEYS, "dau")
    sessions = count_members(_read(spark, lake, SESSIONS), DATE_KEYS, "sessions")
    found = users.join(sessions, DATE_KEYS, "left").withColumn("sessions", F.coalesce("sessions", F.lit(0)))
    return found.orderBy(*_newest_days())


def events_by_country(spark: SparkSession, lake: LakePaths) -> DataFrame:
    totals = _read(spark, lake, EVENTS).where(F.col("country").isNotNull())
    events = totals.groupBy("country").agg(F.sum("rows").alias("events"))
    users = count_members(_read(spark, lake, COUNTRY_USERS), ["country"], "users")
    found = events.join(users, "country", "left").select("country", "events", F.coalesce("users", F.lit(0)).alias("users"))
    return found.orderBy(F.desc("events"), "country")


def hourly_event_rate(spark: SparkSession, lake: LakePaths, as_of: datetime | str, days: int = 7) -> DataFrame:
    """Hours are kept whole, so ``as_of`` counts as the hour it lies in."""
    first = F.date_trunc("hour", clock(as_of)) - F.make_dt_interval(F.lit(days))
    recent = _read(spark, lake, EVENTS).where(F.col("event_hour") >= first)
    totals = recent.groupBy("event_hour", "event_type").agg(F.sum("rows").alias("events"))
    return totals.orderBy(F.desc("event_hour"), F.desc("events"), "event_type")


def partition_freshness(spark: SparkSession, lake: LakePaths) -> DataFrame:
    day = F.concat("year", F.lit("-"), "month", F.lit("-"), "day")
    totals = _read(spark, lake, EVENTS).groupBy("event_type")
    return totals.agg(F.max(day).alias("latest_partition"), F.max("processed_at").alias("last_processed_at")).orderBy("event_type")


def revenue_by_type_country(spark: SparkSession, lake: LakePaths, year: str, month: str) -> DataFrame:
    totals = _read(spark, lake, EVENTS).where((F.col("year") == year) & (F.col("month") == month))
    return totals.groupBy("event_type", "country").agg(_money("value").alias("revenue")).orderBy("event_type", "country")


def kpi_total_events(spark: SparkSession, lake: LakePaths) -> DataFrame:
    return _read(spark, lake, EVENTS).agg(F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"))


def kpi_total_value(spark: SparkSession, lake: LakePaths) -> DataFrame:
    return _read(spark, lake, EVENTS).agg(_money("value").alias("total_value"))


def events_by_type(spark: SparkSession, lake: LakePaths, n: int = CATEGORY_LIMIT) -> DataFrame:
    counts = _read(spark, lake, EVENTS).groupBy("event_type").agg(F.sum("events").alias("events"))
    return top_n_and_other(counts, "event_type", "events", n)


def daily_event_volume(spark: SparkSession, lake: LakePaths) -> DataFrame:
    """Days of event times, which ``event_hour`` lies in whole."""
    totals = _read(spark, lake, EVENTS).groupBy(F.date_trunc("DAY", "event_hour").alias("event_day"))
    return totals.agg(F.sum("events").alias("events")).orderBy("event_day")
