import glob

import pytest
from conftest import DAY, STAMP, event

from clickbasin.functions.dates import ingest_day
from clickbasin.operators.quality import QualityRules
from clickbasin.plans import outcomes
from clickbasin.plans.quality_run import QualityFailure

LATER = ingest_day("2024-03-06")


def rows(spark, lake):
    found = outcomes.read_outcomes(spark, lake).orderBy("run", "step", "day").collect()
    return [(r.run, r.step, r.day, r.status, r.reason, r.rows_in, r.rows_out, r.rows_rejected) for r in found]


def test_every_end_leaves_a_row(spark, lake, drop_lines):
    assert rows(spark, lake) == []
    outcomes.curate_recorded(spark, lake, DAY, "a", at=STAMP)
    outcomes.verify_recorded(spark, lake, DAY, "a", at=STAMP)
    drop_lines(lake.raw, "search", [event(" "), event("1", ts="never")])
    outcomes.curate_recorded(spark, lake, DAY, "b", at=STAMP)
    outcomes.verify_recorded(spark, lake, DAY, "b", at=STAMP)
    drop_lines(lake.raw, "search", [event("1"), event("1"), event(" "), event("2", quantity=7)])
    outcomes.curate_recorded(spark, lake, DAY, "c", at=STAMP)
    outcomes.verify_recorded(spark, lake, DAY, "c", at=STAMP)
    assert rows(spark, lake) == [
        ("a", "quality_checks", "05", "nothing_to_do", "no_data", 0, 0, None),
        ("a", "raw_to_curated", "05", "nothing_to_do", "no_input", 0, 0, 0),
        ("b", "quality_checks", "05", "nothing_to_do", "no_data", 0, 0, None),
        ("b", "raw_to_curated", "05", "done", "no_valid_rows", 2, 0, 2),
        ("c", "quality_checks", "05", "done", None, 2, 2, None),
        ("c", "raw_to_curated", "05", "done", None, 4, 2, 1),
    ]


@pytest.mark.parametrize("raises", [True, False])
def test_the_gate_is_recorded_and_still_raised(spark, lake, drop_lines, raises):
    drop_lines(lake.raw, "search", [event("2", quantity=7)])
    outcomes.curate_recorded(spark, lake, DAY, "a", at=STAMP)
    verify = lambda: outcomes.verify_recorded(
        spark, lake, DAY, "a", QualityRules(max_quantity=5.0), at=STAMP, fail_on_error=raises
    )
    if raises:
        with pytest.raises(QualityFailure, match="Maximum"):
            verify()
    else:
        assert not verify().success
    row = outcomes.read_outcomes(spark, lake).where("step = 'quality_checks'").first()
    assert (row.status, row.reason, row.rows_in) == ("failed", "constraints_failed", 1)
    assert "Maximum(quantity): not met: 7.000000" in row.message
    assert str(row.at) == STAMP


def test_other_failures_are_recorded_and_a_run_again_replaces_its_row(spark, lake, drop_lines):
    drop_lines(lake.raw, "search", [event("1")])
    with pytest.raises(ValueError):
        outcomes.curate_recorded(spark, lake, DAY, "a", at=STAMP, parquet=True)
    assert rows(spark, lake)[0][3:5] == ("failed", "error")
    assert "UnexpectedFormat" in outcomes.read_outcomes(spark, lake).first().message
    outcomes.curate_recorded(spark, lake, DAY, "a", at=STAMP)
    outcomes.curate_recorded(spark, lake, LATER, "a", at=STAMP)
    assert [(r[2], r[3]) for r in rows(spark, lake)] == [("05", "done"), ("06", "nothing_to_do")]
    assert len(glob.glob(f"{lake.outcomes}/run=a/*/*.json")) == 2
