import pytest
from conftest import DAY, event

from clickbasin.functions.dates import fixed_clock, ingest_day
from clickbasin.operators.validate import accepted, rejected, with_verdict
from clickbasin.schemas import CURATED, RAW
from clickbasin.sources.raw import UnexpectedFormat, decode_lines, raw_format, read_raw, read_raw_day


def decoded(spark, *lines, **options):
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    return decode_lines(frame, **options).collect()


def test_malformed_line_keeps_its_text_and_fails_nothing(spark):
    good, bad = decoded(spark, '{"event_id":"1","ts":"t"}', '{"event_id":"2", oops')
    assert good["event_id"] == "1" and good["_malformed_line"] is None
    assert bad["event_id"] is None and bad["_malformed_line"] == '{"event_id":"2", oops'


def test_other_json_is_malformed_and_blank_lines_are_no_rows(spark):
    rows = decoded(spark, "", "   ", '[{"event_id":"1"}]', "null", '"text"')
    assert len(rows) == 3
    assert all(row["event_id"] is None and row["_malformed_line"] for row in rows)


def test_absent_payload_and_keys_are_null(spark):
    none, empty, part = decoded(
        spark, '{"event_id":"1"}', '{"event_id":"2","payload":null}', '{"event_id":"3","payload":{"sku":"s"}}'
    )
    assert none["payload"] is None and empty["payload"] is None
    assert part["payload"].sku == "s" and part["payload"].country is None


def test_wrong_field_type_nulls_the_field_and_keeps_the_row(spark):
    rows = decoded(
        spark,
        '{"event_id":"1","payload":{"quantity":"x","value":1.5}}',
        '{"event_id":"2","payload":{"quantity":3.7,"value":1.5}}',
        '{"event_id":"3","payload":{"value":"2.5","quantity":4}}',
    )
    assert [row["event_id"] for row in rows] == ["1", "2", "3"]
    assert [row["payload"].quantity for row in rows] == [None, None, 4]
    assert [row["payload"].value for row in rows] == [1.5, 1.5, None]


def test_keys_match_in_any_case_and_values_stay(spark):
    line = '{"EVENT_ID":"A\\"TS\\":b","Ts" : "T1","PayLoad":{"Country":"US","QUERY":"SKU is Red"}}'
    (row,) = decoded(spark, line)
    assert (row["event_id"], row["ts"]) == ('A"TS":b', "T1")
    assert (row["payload"].country, row["payload"].query) == ("US", "SKU is Red")
    (strict,) = decoded(spark, line, any_case=False)
    assert strict["event_id"] is None and strict["payload"] is None


def test_declared_spelling_wins(spark):
    both = '{"event_id":"low","EVENT_ID":"up","TS":"t"}'
    (row,) = decoded(spark, both)
    assert (row["event_id"], row["ts"]) == ("low", "t")


def test_day_scan_reads_that_day_only(spark, lake, drop_lines):
    drop_lines(lake.raw, "search", [event("1")])
    drop_lines(lake.raw, "purchase", [event("2")])
    drop_lines(lake.raw, "search", [event("3")], ingest_day("2024-03-06"))
    day = read_raw_day(spark, lake.raw, DAY)
    rows = {row["event_id"]: row for row in day.collect()}
    assert set(rows) == {"1", "2"}
    assert (rows["1"]["event_type"], rows["1"]["month"], rows["1"]["day"]) == ("search", "03", "05")
    assert len(day.inputFiles()) == 2  # the other day was not even listed
    assert read_raw(spark, lake.raw).count() == 3
    assert read_raw_day(spark, lake.raw, ingest_day("2020-01-01")) is None


def test_verdicts(spark):
    rows = [
        (None, "2024-03-05T10:00:00Z", "missing_event_id"),
        ("", "2024-03-05T10:00:00Z", "missing_event_id"),
        ("   ", "garbage", "missing_event_id"),
        ("a", "garbage", "unparseable_ts"),
        ("b", None, "unparseable_ts"),
        ("c", "2024-03-05T10:00:00+05:30", None),
    ]
    raw = spark.createDataFrame(
        [(i, ts, "u", None, "search", "2024", "03", "05") for i, ts, _ in rows], RAW
    )
    judged = with_verdict(raw)
    found = {(r["event_id"], r["ts"]): r["_reject_reason"] for r in judged.collect()}
    assert found == {(i, ts): reason for i, ts, reason in rows}

    good = accepted(judged, fixed_clock("2024-03-06 02:00:00"))
    assert [(f.name, f.dataType) for f in good.schema] == [(f.name, f.dataType) for f in CURATED]
    (row,) = good.select("event_id", good.event_ts.cast("string").alias("at")).collect()
    assert (row["event_id"], row["at"]) == ("c", "2024-03-05 04:30:00")

    bad = rejected(judged)
    assert bad.count() == 5
    assert bad.columns == [*RAW.fieldNames(), "_reject_reason"]


def test_json_is_parsed_once_behind_a_filter(spark):
    frame = spark.createDataFrame([("{}",)], "value string")
    good = accepted(with_verdict(decode_lines(frame, any_case=False).selectExpr(
        "*", "'t' AS event_type", "'2024' AS year", "'03' AS month", "'05' AS day")), fixed_clock(None))
    plan = good._jdf.queryExecution().executedPlan().toString()
    # Once for every line; and twice for a line in which something did not fit, or that names the frame's key.
    assert plan.count("from_json") == 3


def test_a_line_is_one_object_or_malformed(spark):
    good = ['{"event_id":"1"}', ' {"event_id":"1", "payload":{"value":NaN}}  ', '{"event_id":"1","x":"}{"}']
    bad = [
        '{"event_id":"1"}{"event_id":"2"}', '{"event_id":"1"},{"event_id":"2"}', '{"event_id":"1"} # end',
        '{"event_id":"1"}]', '{"event_id":"1"}]}', '[{"event_id":"1"}]', "7", "null",
    ]
    frame = spark.createDataFrame([(line,) for line in good + bad], "value string")
    rows = decode_lines(frame).collect()
    assert [r["event_id"] for r in rows] == ["1"] * len(good) + [None] * len(bad)
    assert [r["_malformed_line"] for r in rows] == [None] * len(good) + bad


def test_format_is_found_and_a_wrong_one_refused(spark, lake, drop_lines):
    drop_lines(lake.raw, "search", [event("1")])
    assert raw_format(spark, lake.raw, DAY) == "lines"
    with pytest.raises(UnexpectedFormat):
        read_raw_day(spark, lake.raw, DAY, parquet=True)
    rows = read_raw_day(spark, lake.raw, DAY).select(*RAW.fieldNames())
    rows.write.mode("append").partitionBy("event_type", "year", "month", "day").parquet(lake.raw)
    with pytest.raises(UnexpectedFormat, match="partly"):
        read_raw_day(spark, lake.raw, DAY)
    assert raw_format(spark, lake.raw, ingest_day("2020-01-01")) is None
