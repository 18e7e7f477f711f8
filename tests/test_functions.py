from datetime import datetime, timezone

import pytest

from clickbasin.functions.dates import fixed_clock, ingest_day
from clickbasin.functions.params import flag, name_list, optional_number
from clickbasin.operators.quality import QualityRules


def test_ingest_day_is_zero_padded():
    assert ingest_day(" 2024-03-05 ") == ("2024", "03", "05")


def test_blank_ingest_day_is_yesterday_in_utc():
    late = datetime.fromisoformat("2024-03-01T01:30:00+05:30")  # still February in UTC
    assert ingest_day("", now=late).iso() == "2024-02-28"
    assert ingest_day(None, now=datetime(2024, 1, 1, tzinfo=timezone.utc)).iso() == "2023-12-31"


@pytest.mark.parametrize("text", ["garbage", "2024-13-01", "05/03/2024"])
def test_bad_ingest_day_raises(text):
    with pytest.raises(ValueError):
        ingest_day(text)


def test_fixed_clock_converts_to_utc(spark):
    moment = datetime.fromisoformat("2024-03-05T10:00:00+05:30")
    shown = spark.range(1).select(fixed_clock(moment).cast("string")).first()[0]
    assert shown == "2024-03-05 04:30:00"


def test_flags_numbers_and_lists():
    assert all(flag(text) for text in ["1", "TRUE", " yes ", "On", True])
    assert not any(flag(text) for text in ["0", "false", "", "y"])
    assert optional_number(" ") is None and optional_number("5") == 5.0
    assert name_list("a, b,, ,c") == ["a", " b", "c"]  # blanks go, the rest is not trimmed


def test_rule_bounds():
    assert QualityRules.from_text("0.5", "0", "a,b", "9").max_quantity == 9.0
    for bad in [{"required_completeness": 0.0}, {"required_completeness": 1.1},
                {"min_user_id_completeness": -0.1}]:
        with pytest.raises(ValueError):
            QualityRules(**bad)
