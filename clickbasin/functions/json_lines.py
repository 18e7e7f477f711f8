"""Column expressions over lines of JSON text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickbasin.schemas import CORRUPT_COLUMN, PAYLOAD, RAW_DATA

_KEYS = [*RAW_DATA.fieldNames(), *PAYLOAD.fieldNames()]


def fold_declared_keys(line: Column) -> Column:
    """Lower the declared key names of a line, leaving every value as it is.

    Quotes inside a JSON string are escaped, so ``"name":`` can only be the end of
    a key.
    """
    for key in _KEYS:
        line = F.regexp_replace(line, rf'"(?i:{key})"(\s*:)', rf'"{key}"$1')
    return line


def decode_unread(line: Column, lowered: Column, decoded: Column) -> Column:
    """Decode again, in lower-case spelling, a line that names a field read as null.

    Null for every other line. The test is a plain substring search for the null
    fields only, far cheaper than a pattern; a hit that is no odd spelling after
    all costs a second decoding and changes nothing.
    """
    fields = [(name, decoded[name]) for name in RAW_DATA.fieldNames()]
    fields += [(name, decoded["payload"][name]) for name in PAYLOAD.fieldNames()]
    unread = [value.isNull() & F.contains(lowered, F.lit(f'"{name}"')) for name, value in fields]
    return F.when(reduce(Column.__or__, unread), decode(fold_declared_keys(line), RAW_DATA))


def merge_decoded(first: Column, again: Column) -> list[Column]:
    """The raw columns of both readings; a key spelled as declared wins."""
    payload = F.when(
        first["payload"].isNotNull() | again["payload"].isNotNull(),
        F.struct(
            *[
                F.coalesce(first["payload"][name], again["payload"][name]).alias(name)
                for name in PAYLOAD.fieldNames()
            ]
        ),
    )
    plain = [name for name in RAW_DATA.fieldNames() if name != "payload"]
    return [F.coalesce(first[name], again[name]).alias(name) for name in plain] + [payload.alias("payload")]


# The line stands in an array under the first key, and the second must still be found behind it.
_LINE, _END = "framed line", "behind the line"


def _framed(line: Column) -> Column:
    return F.concat(F.lit(f'{{"{_LINE}":['), line, F.lit(f'],"{_END}":1}}'))


def decode(line: Column, schema: T.StructType) -> Column:
    """Parse a line into ``schema`` plus the corrupt-record column.

    A line that is not one JSON object and nothing else yields nulls; a field of the
    wrong type yields a null field. In both cases the text is kept in the corrupt column.

    Parsing by itself stops behind the first object, so what follows it on the line (another record, for want
    of a line break) would vanish. Put into an array, with a key behind the array, the line must be an array of
    one and the key must still be found: one pass tells both whether the line is whole and what it says.
    """
    frame = T.StructType(
        [
            T.StructField(_LINE, T.ArrayType(schema)),
            T.StructField(_END, T.IntegerType()),
            T.StructField(CORRUPT_COLUMN, T.StringType()),
        ]
    )
    parsed = F.from_json(_framed(line), frame, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})

    def judged(found: Column) -> Column:
        text, inner = found[CORRUPT_COLUMN], F.get(found[_LINE], 0)
        whole = (F.size(found[_LINE]) == 1) & inner.isNotNull() & found[_END].isNotNull()
        # Where something did not fit, the parser went on behind it: look once more, at the form alone. So are
        # lines that could end the frame's array, whatever they put behind it.
        whole = whole & ((text.isNull() & ~_may_end_frame(line)) | is_one_object(line))
        return F.struct(F.when(whole, inner).alias("inner"), text.isNull().alias("fits"))

    def shown(found: Column) -> Column:
        fields = [found["inner"][field.name].alias(field.name) for field in schema]
        return F.struct(*fields, F.when(found["inner"].isNull() | ~found["fits"], line).alias(CORRUPT_COLUMN))

    # Handed to functions, so that the expressions behind them occur once.
    return F.get(F.transform(F.transform(F.array(parsed), judged), shown), 0)


def as_map(line: Column) -> Column:
    """The keys and values of a line that is one JSON object; null where it is none or cannot be taken apart."""
    shape = T.StructType(
        [
            T.StructField(_LINE, T.ArrayType(T.MapType(T.StringType(), T.VariantType()))),
            T.StructField(_END, T.IntegerType()),
        ]
    )

    def judged(found: Column) -> Column:
        whole = (F.size(found[_LINE]) == 1) & found[_END].isNotNull()
        return F.when(whole & (~_may_end_frame(line) | is_one_object(line)), F.get(found[_LINE], 0))

    return F.get(F.transform(F.array(F.from_json(_framed(line), shape)), judged), 0)


def _may_end_frame(line: Column) -> Column:
    return F.contains(line, F.lit("]"))


def is_one_object(line: Column) -> Column:
    """Whether the line holds exactly one JSON object, as ``decode`` finds out besides."""
    shape = T.StructType(
        [
            T.StructField(_LINE, T.ArrayType(T.StructType([T.StructField("_", T.StringType())]))),
            T.StructField(_END, T.IntegerType()),
        ]
    )
    # The frame has two keys; a line that ended its array has put others behind it.
    keys = F.size(F.map_keys(F.from_json(_framed(line), "map<string,string>")))
    return F.exists(
        F.array(F.from_json(_framed(line), shape)),
        lambda f: (F.size(f[_LINE]) == 1)
        & F.get(f[_LINE], 0).isNotNull()
        & f[_END].isNotNull()
        & (~_may_end_frame(line) | (keys == 2)),
    ).eqNullSafe(True)


def is_blank(line: Column) -> Column:
    return F.trim(line) == ""
