import pytest

from clickbasin.functions.json_lines import as_map, decode, is_one_object
from clickbasin.schemas import CORRUPT_COLUMN, RAW_DATA

WHOLE = ['{"event_id":"a","payload":{"l":[1,[2]],"t":"]}"}}', '{"event_id":"1"}', ' {"a":{}} ', "{}", '{"event_id":"framed line"}', '{"framed line":[1],"event_id":"x"}', '{"event_id":"a","event_id":"b"}']
BROKEN = [
    "", "null", "1", "[]", "[{}]", "{} {}", "{},{}", '{"event_id":"1"', '{"event_id":"1"}]}', '{"event_id":"1"} # end', '{"event_id":"q" "x"}',
    '{"event_id":"x"],"line":[{"event_id":"y"}', '{"event_id":"x"}],"framed line":[{"event_id":"y"}', '{"event_id":"x"}],"behind the line":1,"a":[{}',
    '{"event_id":"a"},"z":1', '"x"', None,
]


@pytest.mark.parametrize("line", WHOLE + BROKEN)
def test_only_one_whole_object_is_decoded(spark, line):
    frame = spark.createDataFrame([(line,)], "value string")
    got = frame.select(decode(frame.value, RAW_DATA).alias("d"), as_map(frame.value).isNotNull().alias("m")).first()
    if line in WHOLE:
        assert got.d[CORRUPT_COLUMN] is None
        assert got.m or line.count("event_id") > 1
        assert frame.select(is_one_object(frame.value)).first()[0]
    else:
        assert list(got.d)[:-1] == [None] * 4 and got.d[CORRUPT_COLUMN] == line
        assert not got.m
        assert not frame.select(is_one_object(frame.value)).first()[0]


def test_the_object_itself_is_read_whatever_it_names(spark):
    lines = ['{"framed line":[1],"event_id":"x"}', '{"event_id":"a","payload":{"quantity":"many","country":"DE"}}']
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    first, second = [row.d for row in frame.select(decode(frame.value, RAW_DATA).alias("d")).collect()]
    assert first.event_id == "x" and first[CORRUPT_COLUMN] is None
    assert (second.event_id, second.payload.country, second.payload.quantity) == ("a", "DE", None)
    assert second[CORRUPT_COLUMN] == lines[1]
