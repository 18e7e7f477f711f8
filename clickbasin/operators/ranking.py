"""Leading categories, with the remainder folded into one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_n_and_other(
    counts: DataFrame, category: str, measure: str, n: int, other_label: str = "other"
) -> DataFrame:
    """``category, measure, is_other``: the n largest categories and the sum of the rest.

    ``counts`` has one row per category. ``is_other`` tells the folded row from a
    category that happens to bear its label. Equal measures rank by category.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    leaders = (
        counts.orderBy(F.desc(measure), F.asc(category)).limit(n).select(F.col(category).alias("_leader"),
                                                                        F.lit(True).alias("_kept"))
    )
    marked = counts.join(leaders, F.col(category).eqNullSafe(F.col("_leader")), "left")
    folded = F.col("_kept").isNull()
    return (
        marked.select(
            F.when(folded, F.lit(other_label)).otherwise(F.col(category)).alias(category),
            measure,
            folded.alias("is_other"),
        )
        .groupBy("is_other", category)
        .agg(F.sum(measure).alias(measure))
        .select(category, measure, "is_other")
        .orderBy("is_other", F.desc(measure), category)
    )
