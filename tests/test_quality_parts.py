import glob

import pytest
from test_quality import timed
from test_reports import row

from clickbasin.operators import quality_parts
from clickbasin.operators.quality import QualityRules, measure
from clickbasin.schemas import DATE_KEYS

RULES = QualityRules(allowed_event_types=("search",), max_quantity=5.0)


def measures(frame):
    return sorted(tuple(sorted(row.asDict().items(), key=str)) for row in frame.collect())


@pytest.mark.parametrize("buckets", [1, 4])
def test_drops_add_up_to_all_rows(spark, tmp_path, buckets):
    root = str(tmp_path / "q")
    drops = [
        [row(1), row(2), row(3), row(1, day="06"), row(9, "odd", quantity=-1)],
        [row(3, user_id=None), row(4, value=-1.0), row(5), row(5)],  # one id again, one twice
        [row(1, day="06"), row(1, day="07", quantity=9)],
    ]
    for n, rows in enumerate(drops):
        quality_parts.add_drop(timed(spark, rows), root, n, RULES, buckets)
        whole = timed(spark, [r for part in drops[: n + 1] for r in part])
        assert measures(quality_parts.measures(spark, root)) == measures(measure(whole, RULES, DATE_KEYS))
    # Taken in again, also with other rows: it replaces itself.
    drops[2] = [row(1, day="06"), row(8, day="07")]
    quality_parts.add_drop(timed(spark, drops[2]), root, 2, RULES, buckets)
    whole = timed(spark, [r for part in drops for r in part])
    assert measures(quality_parts.measures(spark, root)) == measures(measure(whole, RULES, DATE_KEYS))


def test_ids_without_a_value_and_days_without_an_id(spark, tmp_path):
    root = str(tmp_path / "q")
    frame = timed(spark, [row(1), row(2, day="06")]).selectExpr("* EXCEPT (event_id)", "IF(day = '05', event_id, NULL) AS event_id")
    quality_parts.add_drop(frame, root, 0, RULES, 2)
    assert measures(quality_parts.measures(spark, root)) == measures(measure(frame, RULES, DATE_KEYS))


def test_only_touched_buckets_are_read_again(spark, tmp_path):
    root = str(tmp_path / "q")
    quality_parts.add_drop(timed(spark, [row(n) for n in range(200)]), root, 0, RULES, 16)
    quality_parts.add_drop(timed(spark, [row(7)]), root, 1, RULES, 16)
    assert len(glob.glob(f"{root}/copies/drop=0/*/*/*/bucket=*")) == 16
    counts = spark.read.parquet(f"{root}/counts")
    assert counts.where("drop = 1").count() == 1
    assert measures(quality_parts.measures(spark, root)) == measures(measure(timed(spark, [row(n) for n in [*range(200), 7]]), RULES, DATE_KEYS))
