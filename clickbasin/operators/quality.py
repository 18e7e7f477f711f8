"""Quality constraints as Spark aggregates.

``measure`` reduces a curated partition to one row of plain numbers,
``constraint_results`` judges them (a row per constraint), ``summary`` and
``metrics`` condense the verdict. All take ``by``: no columns for one verified
partition, or the date columns to verify many days in one job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickbasin.functions.params import name_list, optional_number

# Check names, levels and states, mandatory columns, metric names.
ERROR_CHECK = "curated-events-quality"
WARNING_CHECK = "curated-events-warnings"
ERROR = "Error"
WARNING = "Warning"
SUCCESS = "Success"
FAILURE = "Failure"
REQUIRED_COLUMNS = ["event_id", "event_ts", "event_type"]
CONSTRAINTS_FAILED = "ConstraintsFailed"
CONSTRAINTS_TOTAL = "ConstraintsTotal"
ROWS_VERIFIED = "RowsVerified"
CHECK_SUCCESS = "CheckSuccess"


@dataclass(frozen=True)
class QualityRules:
    required_completeness: float = 1.0
    min_user_id_completeness: float = 0.9
    allowed_event_types: tuple[str, ...] = ()
    max_quantity: float | None = None

    def __post_init__(self) -> None:
        if not 0 < self.required_completeness <= 1:
            raise ValueError("required_completeness must be in (0, 1]")
        if not 0 <= self.min_user_id_completeness <= 1:
            raise ValueError("min_user_id_completeness must be in [0, 1]")

    @classmethod
    def from_text(
        cls,
        required_completeness: str = "1.0",
        min_user_id_completeness: str = "0.9",
        allowed_event_types: str = "",
        max_quantity: str = "",
    ) -> QualityRules:
        return cls(
            float(required_completeness),
            float(min_user_id_completeness),
            tuple(name_list(allowed_event_types)),
            optional_number(max_quantity),
        )


@dataclass(frozen=True)
class _Constraint:
    level: str
    name: str
    value: Column
    holds: Column


def totals(events: DataFrame, rules: QualityRules, by: Sequence[str] = ()) -> DataFrame:
    """The measurements that add up: counts, and a maximum."""
    outside = (
        ~F.col("event_type").isin(list(rules.allowed_event_types))
        if rules.allowed_event_types
        else F.lit(False)
    )
    return events.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("event_ts").alias("event_ts_present"),
        F.count("event_type").alias("event_type_present"),
        F.count("user_id").alias("user_id_present"),
        F.count_if(F.col("value") < 0).alias("negative_values"),
        F.count_if(F.col("quantity") < 0).alias("negative_quantities"),
        F.max("quantity").alias("max_quantity"),
        F.count_if(outside).alias("outside_types"),
    )


def measure(events: DataFrame, rules: QualityRules, by: Sequence[str] = ()) -> DataFrame:
    """One row of measurements per group.

    Two scans that share no data column. The first needs no shuffle beyond one
    partial row per task and group. The second reads the id alone and counts it
    in two steps; copies are summed in the map tasks, so an id holding much of
    the data is no hot spot. A last tiny aggregate merges their rows, no join.
    """
    added = totals(events, rules, by)
    ids = (
        events.where(F.col("event_id").isNotNull())
        .groupBy(*by, "event_id")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .groupBy(*by)
        .agg(
            F.sum("_copies").alias("event_id_present"),
            F.count_if(F.col("_copies") == 1).alias("single_event_ids"),
        )
    )
    # A group without a single id has no row on the second side.
    return (
        added.unionByName(ids, allowMissingColumns=True)
        .groupBy(*by)
        .agg(
            *[F.max(name).alias(name) for name in added.columns if name not in by],
            *[
                F.coalesce(F.max(name), F.lit(0)).alias(name)
                for name in ids.columns
                if name not in by
            ],
        )
    )


def _share(part: Column) -> Column:
    return F.try_divide(part.cast("double"), F.col("rows").cast("double"))


def _at_least(share: Column, least: float) -> Column:
    return F.coalesce(share >= F.lit(float(least)), F.lit(False))


def _constraints(rules: QualityRules) -> list[_Constraint]:
    rows = F.col("rows")
    found = [_Constraint(ERROR, "Size", rows.cast("double"), rows > 0)]
    for name in REQUIRED_COLUMNS:
        present = _share(F.col(f"{name}_present"))
        found.append(
            _Constraint(
                ERROR, f"Completeness({name})", present, _at_least(present, rules.required_completeness)
            )
        )
    unique = _share(F.col("single_event_ids"))
    found.append(_Constraint(ERROR, "Uniqueness(event_id)", unique, _at_least(unique, 1.0)))

    def compliance(name: str, offending: str) -> _Constraint:
        within = _share(rows - F.col(offending))
        return _Constraint(ERROR, f"Compliance({name})", within, F.col(offending) == 0)

    found.append(compliance("value is non-negative", "negative_values"))
    found.append(compliance("quantity is non-negative", "negative_quantities"))
    if rules.max_quantity is not None:
        top = F.col("max_quantity").cast("double")
        within = F.coalesce(top <= F.lit(rules.max_quantity), F.lit(False))
        found.append(_Constraint(ERROR, "Maximum(quantity)", top, within))
    if rules.allowed_event_types:
        found.append(compliance("event_type in allowed set", "outside_types"))
    known = _share(F.col("user_id_present"))
    found.append(
        _Constraint(
            WARNING, "Completeness(user_id)", known, _at_least(known, rules.min_user_id_completeness)
        )
    )
    return found


def _message(constraint: _Constraint) -> Column:
    shown = F.coalesce(constraint.value.cast("decimal(28,6)").cast("string"), F.lit("no value"))
    return F.when(constraint.holds, "").otherwise(F.concat(F.lit("not met: "), shown))


def constraint_results(measures: DataFrame, rules: QualityRules, by: Sequence[str] = ()) -> DataFrame:
    """A row per constraint: eight to ten, in the order they are checked."""
    constraints = _constraints(rules)

    def check_status(level: str) -> Column:
        all_hold = reduce(Column.__and__, [c.holds for c in constraints if c.level == level])
        return F.when(all_hold, SUCCESS).otherwise(level)

    entries = [
        F.struct(
            F.lit(ERROR_CHECK if c.level == ERROR else WARNING_CHECK).alias("check"),
            F.lit(c.level).alias("check_level"),
            check_status(c.level).alias("check_status"),
            F.lit(c.name).alias("constraint"),
            F.when(c.holds, SUCCESS).otherwise(FAILURE).alias("constraint_status"),
            _message(c).alias("constraint_message"),
        )
        for c in constraints
    ]
    return measures.select(
        *by, F.col("rows").alias("rows_verified"), F.inline(F.array(*entries))
    ).select(
        *by,
        "check",
        "check_level",
        "check_status",
        "constraint",
        "constraint_status",
        "constraint_message",
        "rows_verified",
    )


def summary(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Failed error-level constraints, all constraints, and the 0/1 verdict."""
    failed = (F.col("check_level") == ERROR) & (F.col("constraint_status") != SUCCESS)
    return (
        results.groupBy(*by)
        .agg(
            F.count_if(failed).alias("constraints_failed"),
            F.count(F.lit(1)).alias("constraints_total"),
            F.coalesce(F.max("rows_verified"), F.lit(0).cast("long")).alias("rows_verified"),
        )
        .withColumn("check_success", F.when(F.col("constraints_failed") > 0, 0).otherwise(1))
    )


def metrics(summaries: DataFrame, namespace: str, job_name: str, ts: Column) -> DataFrame:
    """Four metric rows per summary row, in the metrics table's columns."""
    sources = {
        CONSTRAINTS_FAILED: "constraints_failed",
        CONSTRAINTS_TOTAL: "constraints_total",
        ROWS_VERIFIED: "rows_verified",
        CHECK_SUCCESS: "check_success",
    }
    points = [
        F.struct(F.lit(metric).alias("metric"), F.col(column).cast("double").alias("value"))
        for metric, column in sources.items()
    ]
    return summaries.select(ts.alias("ts"), F.inline(F.array(*points))).select(
        F.lit(namespace).alias("namespace"),
        F.lit(job_name).alias("job_name"),
        "metric",
        "value",
        F.lit("Count").alias("unit"),
        "ts",
    )
