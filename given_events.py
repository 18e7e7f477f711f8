"""The given ``events`` table in the shapes the library works on.

``k`` is the number in ``props``. Faults (blank ids, bad times, cut lines, odd
spellings) depend on ``k`` or the id, so that every rule has rows to act on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickbasin.functions.dates import IngestDay
from clickbasin.operators.quality import QualityRules
from clickbasin.plans.curate import write_curated
from clickbasin.plans.daily_run import run_day
from clickbasin.plans.outcomes import curate_recorded, verify_recorded
from clickbasin.plans.paths import LakePaths
from clickbasin.plans.quality_run import QualityFailure
from clickbasin.plans.totals import refresh_totals
from clickbasin.schemas import PARTITION_KEYS
from clickbasin.session import pin, scratch_path
from clickbasin.sources.storage import replace_day
from clickbasin.streaming.landing import line_stream, start_landing

# The day on which the streamed lines are said to arrive.
ARRIVAL = IngestDay("2024", "02", "01")
ARRIVAL_TS = "2024-02-01 06:00:00"
PROCESSED_AT = "2024-02-02 03:00:00"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ``k`` is generated, not projected: the shapes below use it many times, and
    # filters on them would otherwise read the JSON again for every use.
    return pin(spark).read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.col("ts").cast("date").cast("string").alias("date"),
        F.explode(F.array(F.get_json_object("props", "$.k").cast("int"))).alias("k"),
    )


def curated_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "ts AS event_ts",
        "CASE WHEN k % 17 <> 0 THEN CAST(user_id AS STRING) END AS user_id",
        "CASE k % 7 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'IN' WHEN 3 THEN 'DE'"
        " WHEN 4 THEN 'BR' WHEN 5 THEN 'JP' END AS country",
        "concat('s-', CAST(user_id AS STRING), '-', CAST(k % 3 AS STRING)) AS session_id",
        "value",
        "CASE WHEN event_type = 'error' THEN CASE k % 5 WHEN 0 THEN 'Shoes' WHEN 1 THEN 'shoes'"
        " WHEN 2 THEN 'laptop' WHEN 3 THEN '' END END AS query",
        "CASE WHEN event_type IN ('click', 'purchase') AND k % 11 <> 0"
        " THEN concat('SKU-', CAST(1000 + k AS STRING)) END AS sku",
        "CASE WHEN event_type IN ('click', 'purchase') THEN 1 + k % 5 END AS quantity",
        "ts + INTERVAL '1' DAY AS processed_at",
        "CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'"
        " WHEN 'signup' THEN 'login' WHEN 'error' THEN 'search' ELSE event_type END AS event_type",
        "substr(date, 1, 4) AS year",
        "substr(date, 6, 2) AS month",
        "substr(date, 9, 2) AS day",
    )


def curated_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated shape with a few rows that break each quality constraint."""
    n = F.col("event_id").cast("long")
    return curated_shape(spark, sf_dir).withColumns(
        {
            "event_id": F.when(n % 997 == 500, None)
            .when(n % 499 == 1, (n - 1).cast("string"))
            .otherwise(F.col("event_id")),
            "value": F.when(n % 389 == 7, -F.col("value") - 1).otherwise(F.col("value")),
            "quantity": F.when((n % 211 == 3) & F.col("quantity").isNotNull(), F.lit(40)).otherwise(
                F.col("quantity")
            ),
        }
    )


def raw_shape(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        *more,
        "CASE WHEN k % 13 = 0 THEN ' ' WHEN k % 29 = 0 THEN NULL"
        " ELSE CAST(CASE WHEN event_id % 5 = 1 THEN event_id - 1 ELSE event_id END AS STRING) END AS event_id",
        "CASE WHEN k % 19 = 0 THEN 'not-a-timestamp'"
        " ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'\") END AS ts",
        "CAST(user_id AS STRING) AS user_id",
        "named_struct('country', CASE WHEN k % 7 <> 6 THEN concat('C', CAST(k % 7 AS STRING)) END,"
        " 'session_id', concat('s-', CAST(user_id AS STRING)), 'value', value,"
        " 'query', CASE WHEN event_type = 'error' THEN 'tent' END,"
        " 'sku', CASE WHEN event_type = 'purchase' THEN concat('SKU-', CAST(k AS STRING)) END,"
        " 'quantity', CASE WHEN event_type = 'purchase' THEN 1 + k % 5 END) AS payload",
        "event_type",
        "substr(date, 1, 4) AS year",
        "substr(date, 6, 2) AS month",
        "substr(date, 9, 2) AS day",
    )


def curated_with_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated shape with many search terms, some as frequent as others."""
    n = F.col("event_id").cast("long")
    term = F.concat(F.when(n % 2 == 0, "Item ").otherwise("ITEM "), (n % 173).cast("string"))
    return curated_shape(spark, sf_dir).withColumn("query", F.when(F.col("event_type") == "search", term))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a line of JSON text, some of them damaged.

    By ``k``: cut off (23), without (31), with empty (37) or null (41) type;
    id key in capitals (43), country key capitalised (17); quantity as text (19);
    a key nobody declared (29); quantity beyond an integer (13); a payload key twice
    (53); a second object on the line (47); other text behind the object (59).
    """
    return _keyed_lines(spark, sf_dir).select("value")


def arriving_lines(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The lines in three parts of a tenth, three and six tenths."""
    lines, tenth = _keyed_lines(spark, sf_dir), F.col("k") % 10
    return [lines.where(part).select("value") for part in (tenth == 0, tenth.between(1, 3), tenth > 3)]


def _keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .selectExpr(
            "k",
            "concat('{',"
            " CASE WHEN k % 31 = 30 THEN '' WHEN k % 37 = 36 THEN '\"event_type\":\"\",'"
            " WHEN k % 41 = 40 THEN '\"event_type\":null,'"
            " ELSE concat('\"event_type\":\"', event_type, '\",') END,"
            " CASE WHEN k % 43 = 42 THEN '\"EVENT_ID\":\"' ELSE '\"event_id\":\"' END,"
            " CAST(CASE WHEN event_id % 5 = 1 THEN event_id - 1 ELSE event_id END AS STRING), '\",',"
            " '\"ts\":\"', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'\"), '\",',"
            " '\"user_id\":\"', CAST(user_id AS STRING), '\",',"
            " '\"payload\":{', CASE WHEN k % 17 = 16 THEN '\"Country\":\"C' ELSE '\"country\":\"C' END,"
            " CAST(k % 7 AS STRING), '\",',"
            " CASE WHEN k % 53 = 52 THEN '\"session_id\":\"none\",' ELSE '' END,"
            " '\"session_id\":\"s-', CAST(user_id AS STRING), '\",',"
            " CASE WHEN event_type = 'error' THEN '\"query\":\"Trail tent\",' ELSE '' END,"
            " CASE WHEN event_type = 'purchase' THEN concat('\"sku\":\"SKU-', CAST(k AS STRING),"
            "   '\",\"quantity\":', CASE WHEN k % 19 = 18 THEN '\"many\"'"
            "   WHEN k % 13 = 12 THEN '3000000000' ELSE CAST(1 + k % 5 AS STRING) END, ',')"
            "   ELSE '' END,"
            " CASE WHEN k % 29 = 28 THEN '\"coupon\":\"WINTER\",' ELSE '' END,"
            " '\"value\":', CAST(CAST(value AS DECIMAL(18,2)) AS STRING), '}}') AS line",
        )
        .selectExpr(
            "k",
            "CASE WHEN k % 23 = 22 THEN left(line, 45) WHEN k % 47 = 46 THEN concat(line, line)"
            " WHEN k % 59 = 58 THEN concat(line, ' # end') ELSE line END AS value"
        )
    )


# Tables written once per session and data folder; others read them.
_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = scratch_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def raw_table(spark: SparkSession, sf_dir: str) -> str:
    """The raw shape as gzip JSON under event_type/year/month/day."""

    def write(path: str) -> None:
        rows = raw_shape(spark, sf_dir).hint("rebalance", *PARTITION_KEYS)
        rows.write.partitionBy(*PARTITION_KEYS).option("compression", "gzip").json(path)

    return _once(spark, sf_dir, "raw", write)


def curated_lake(spark: SparkSession, sf_dir: str) -> LakePaths:
    """A lake whose curated layer has the curated shape as Parquet under event_type/year/month/day."""

    def write(path: str) -> None:
        write_curated(curated_shape(spark, sf_dir), LakePaths(path).curated)

    return LakePaths(_once(spark, sf_dir, "curated", write))


def processed_lake(spark: SparkSession, sf_dir: str, rules: QualityRules) -> LakePaths:
    """A lake that got all raw rows on one day, which was then curated, verified and put on the dashboard."""

    def write(path: str) -> None:
        lake = LakePaths(path)
        date = {"year": ARRIVAL.year, "month": ARRIVAL.month, "day": ARRIVAL.day}
        rows = raw_shape(spark, sf_dir).withColumns({name: F.lit(value) for name, value in date.items()})
        rows.hint("rebalance", "event_type").write.partitionBy(*PARTITION_KEYS).json(lake.raw)
        report = run_day(
            spark, lake, ARRIVAL, rules=rules, processed_at=PROCESSED_AT, fail_on_error=False
        )
        if not report.where("status = 'FAILED'").isEmpty():
            raise RuntimeError(report.collect())

    return LakePaths(_once(spark, sf_dir, "processed", write))


# Three ingest days for the days of a month, and one on which nothing arrives.
FOLDED_DAYS = [IngestDay("2024", "03", f"0{n}") for n in (1, 2, 3)]
EMPTY_DAY = IngestDay("2024", "03", "04")


def _folded(rows: DataFrame) -> DataFrame:
    """Rows dealt to the folded days by their day of the month."""
    third = F.floor((F.col("day").cast("int") - 1) / 11) + 1
    return rows.withColumns({"year": F.lit("2024"), "month": F.lit("03"), "day": F.lpad(third.cast("string"), 2, "0")})


def folded_drops(spark: SparkSession, sf_dir: str, moment: str) -> list[DataFrame]:
    """``two_drops`` on the folded days."""
    return [_folded(part) for part in two_drops(spark, sf_dir, moment)]


def drifted_files(spark: SparkSession, sf_dir: str) -> str:
    """The curated shape, a file a partition, with three schemas by the day of the month."""

    def write(path: str) -> None:
        rows, day = curated_shape(spark, sf_dir), F.col("day")
        parts = [
            rows.where(day <= "10"),
            rows.where((day > "10") & (day <= "20")).withColumn("quantity", F.col("quantity").cast("string")),
            rows.where(day > "20").drop("sku").withColumn("coupon", F.lit("WINTER")),
        ]
        for part in parts:
            part.repartition(*PARTITION_KEYS).write.mode("append").partitionBy(*PARTITION_KEYS).parquet(path)

    return _once(spark, sf_dir, "drifted", write)


def outcome_lake(spark: SparkSession, sf_dir: str) -> LakePaths:
    """A lake whose raw rows came on the folded days, curated and verified with a row for each step.

    The second day has no valid row, the third fails its gate, and on a fourth nothing arrived.
    """

    def write(path: str) -> None:
        lake = LakePaths(path)
        rows = _folded(raw_shape(spark, sf_dir))
        rows = rows.withColumn("ts", F.when(F.col("day") == FOLDED_DAYS[1].day, F.lit("never")).otherwise(F.col("ts")))
        rows.hint("rebalance", "event_type", "day").write.partitionBy(*PARTITION_KEYS).json(lake.raw)
        for day in [*FOLDED_DAYS, EMPTY_DAY]:
            curate_recorded(spark, lake, day, "nightly", at=PROCESSED_AT)
            rules = QualityRules(max_quantity=2.0 if day == FOLDED_DAYS[2] else None)
            try:
                verify_recorded(spark, lake, day, "nightly", rules, at=PROCESSED_AT)
            except QualityFailure:
                pass  # the row says so

    return LakePaths(_once(spark, sf_dir, "outcomes", write))


def summarised_lake(spark: SparkSession, sf_dir: str, day: IngestDay) -> LakePaths:
    """The curated shape with its totals, of which ``day`` was half there at first and was curated again."""

    def write(path: str) -> None:
        lake = LakePaths(path)
        rows = curated_shape(spark, sf_dir)
        half = ~day.condition() | (F.col("event_id").cast("long") % 2 == 0)
        write_curated(rows.where(half), lake.curated)
        refresh_totals(spark, lake)
        replace_day(spark, lake.curated, day, lambda path: write_curated(rows.where(day.condition()), path))
        refresh_totals(spark, lake, day)

    return LakePaths(_once(spark, sf_dir, "summarised", write))


def two_drops(spark: SparkSession, sf_dir: str, moment: str) -> list[DataFrame]:
    """The raw shape in two parts: what is before ``moment``, and then the rest with a tenth of it again."""
    rows = raw_shape(spark, sf_dir, "ts AS at", "k")
    early = F.col("at") < F.lit(moment).cast("timestamp")
    return [part.drop("at", "k") for part in (rows.where(early), rows.where(~early | (F.col("k") % 10 == 0)))]


def landed_lake(spark: SparkSession, sf_dir: str, *, parquet: bool = False) -> LakePaths:
    """A lake whose raw layer got all event lines through the landing stream."""

    def write(path: str) -> None:
        lake = LakePaths(path)
        incoming = f"{path}/incoming"
        event_lines(spark, sf_dir).write.text(incoming)
        start_landing(
            line_stream(spark, incoming),
            lake,
            f"{path}/landing-checkpoint",
            parquet=parquet,
            drain=True,
            arrival=F.lit(ARRIVAL_TS).cast("timestamp"),
        ).awaitTermination()

    return LakePaths(_once(spark, sf_dir, "lake-parquet" if parquet else "lake", write))
