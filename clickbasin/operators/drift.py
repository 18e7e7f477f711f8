"""Schema drift, reported and never applied."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickbasin.functions.dates import IngestDay
from clickbasin.functions.json_lines import as_map, is_one_object
from clickbasin.session import small_frame
from clickbasin.sources.storage import day_glob, glob, scheme

ADDED = "added"
MISSING = "missing"
TYPE_CHANGED = "type_changed"
UNREADABLE = "unreadable"
# Stands for a column where a whole line cannot be taken apart.
WHOLE_LINE = "(line)"
WHOLE_FILE = "(file)"

_DRIFT = "column string, declared_type string, found_type string, change string"


def file_schema_drift(spark: SparkSession, declared: T.StructType, found: T.StructType) -> DataFrame:
    """Compare a declared schema with the one files carry, column by column."""
    wanted = {field.name: field.dataType.simpleString() for field in declared}
    seen = {field.name: field.dataType.simpleString() for field in found}
    rows = [(name, kind, None, MISSING) for name, kind in wanted.items() if name not in seen]
    rows += [(name, None, kind, ADDED) for name, kind in seen.items() if name not in wanted]
    rows += [
        (name, kind, seen[name], TYPE_CHANGED)
        for name, kind in wanted.items()
        if name in seen and seen[name] != kind
    ]
    return small_frame(spark, rows, _DRIFT)


def parquet_schema(spark: SparkSession, path: str) -> T.StructType:
    """The merged schema of the files below ``path``; it fails where types disagree, see ``parquet_drift``."""
    return spark.read.option("mergeSchema", True).parquet(path).schema


# Fixed value: where Spark's writer keeps the schema it wrote.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
_FILE_DRIFT = _DRIFT + ", files bigint"


def _deviations(declared: T.StructType, opener: Callable[[str], BinaryIO] | None):
    """For ``mapInArrow`` over paths and contents: a row for each deviation of each file.

    Closed over nothing of this package, as executors need not have it.
    """
    wanted = {field.name: field.dataType.simpleString() for field in declared}
    names, spark_schema = ["column", "declared_type", "found_type", "change"], _SPARK_SCHEMA
    added, missing, changed, broken = ADDED, MISSING, TYPE_CHANGED, (WHOLE_FILE, None, None, UNREADABLE)

    def columns(source) -> dict[str, str]:
        import json

        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema
        from pyspark.sql.types import StructType

        file = pq.ParquetFile(source)
        known = (file.metadata.metadata or {}).get(spark_schema)
        if known:
            return {f.name: f.dataType.simpleString() for f in StructType.fromJson(json.loads(known))}
        # The old 96-bit timestamps say nothing of zones; Spark reads them as instants.
        leaves = [file.schema.column(i) for i in range(len(file.schema))]
        old = {leaf.path for leaf in leaves if leaf.physical_type == "INT96"}
        fields = from_arrow_schema(file.schema_arrow, prefer_timestamp_ntz=True)
        return {f.name: "timestamp" if f.name in old else f.dataType.simpleString() for f in fields}

    def opened(path: str, content: bytes | None):
        if content is not None:
            return pa.BufferReader(content)
        return opener(path) if opener else open(path.removeprefix("file:"), "rb")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for path, content in zip(*(column.to_pylist() for column in batch.columns)):
                with opened(path, content) as source:
                    try:
                        seen = columns(source)
                    except (pa.ArrowException, ValueError):
                        found.append(broken)
                        continue
                found += [(name, kind, None, missing) for name, kind in wanted.items() if name not in seen]
                found += [(name, None, kind, added) for name, kind in seen.items() if name not in wanted]
                found += [(name, kind, seen[name], changed) for name, kind in wanted.items() if seen.get(name, kind) != kind]
            yield pa.RecordBatch.from_arrays([pa.array([row[n] for row in found], pa.string()) for n in range(4)], names=names)

    return read


def parquet_drift(
    spark: SparkSession,
    root: str,
    day: IngestDay | None,
    declared: T.StructType,
    opener: Callable[[str], BinaryIO] | None = None,
) -> DataFrame:
    """``column, declared_type, found_type, change, files``: how Parquet files deviate from a declared schema.

    The files of an ingest day, or all below ``root``, are listed by Spark and dealt over tasks. Tasks read
    the footers and compare them, file by file: schemas are never merged, as merging fails on the very type
    changes that are looked for. What is shuffled is a row for each kind of deviation, with the number of files.
    A file that is no Parquet is ``unreadable``, as column ``(file)``; one without a byte is passed over, as it is by any scan.

    ``opener`` opens a path on an executor, for reading at any place. Without it, files that all machines
    mount (``file:``) are opened as they are, and other files are read whole by Spark.
    """
    where = root if day is None else day_glob(root, day)
    if not glob(spark, where):
        return small_frame(spark, [], _FILE_DRIFT)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(where)
    by_path = opener is not None or scheme(spark, root) == "file"
    content = F.lit(None).cast("binary") if by_path else F.col("content")
    found = files.select("path", content.alias("content")).mapInArrow(_deviations(declared, opener), _DRIFT)
    return found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("files"))


# JSON types a declared type reads without loss.
_FITTING = {
    "string": ["STRING"],
    "double": ["DOUBLE", "DECIMAL", "BIGINT", "FLOAT"],
    "int": ["BIGINT"],
    "bigint": ["BIGINT"],
    "struct": ["OBJECT"],
}


def json_drift(lines: DataFrame, declared: T.StructType) -> DataFrame:
    """``column, json_type, change, rows`` for keys of JSON lines that left the schema.

    ``column`` is a key or ``parent.key``; declared keys match in any case. A line is parsed once into
    pairs of key and type, which are counted in the map tasks; what is compared with the schema is a row
    for each pair that occurs, and a row for each declared key. A number that the
    declared integer cannot hold deviates as ``BIGINT`` or ``DECIMAL``. A declared key no
    line has is ``missing`` with zero rows. An object whose keys cannot be taken apart (a
    key occurs twice inside) is ``unreadable``, as column ``(line)``. Null values and lines
    that are not one JSON object are no evidence either way.
    """
    structs = [field.name for field in declared if isinstance(field.dataType, T.StructType)]
    kinds: dict[str, str] = {}
    for field in declared:
        kinds[field.name] = "struct" if field.name in structs else field.dataType.simpleString()
        if field.name in structs:
            kinds |= {f"{field.name}.{inner.name}": inner.dataType.simpleString() for inner in field.dataType}
    integers = [path for path, kind in kinds.items() if kind == "int"]

    def found(path: Column, value: Column) -> Column:
        known = F.when(F.lower(path).isin(list(kinds)), F.lower(path)).otherwise(path)
        kind = F.schema_of_variant(value)  # such as DECIMAL(4,2) or OBJECT<a: BIGINT>
        too_large = F.lower(path).isin(integers) & F.try_variant_get(value, "$", "int").isNull()
        return F.struct(
            known.alias("column"), F.regexp_extract(kind, "^[A-Z]+", 0).alias("json_type"), too_large.alias("too_large")
        )

    def members(entry: Column) -> Column:
        inner = F.map_entries(F.try_variant_get(entry["value"], "$", "map<string,variant>"))
        return F.transform(inner, lambda m: found(F.concat(F.lower(entry["key"]), F.lit("."), m["key"]), m["value"]))

    keys = F.map_entries("_map")
    nested = F.transform(F.filter(keys, lambda e: F.lower(e["key"]).isin(structs)), members)
    pairs = F.concat(
        F.transform(keys, lambda e: found(e["key"], e["value"])), F.flatten(F.filter(nested, lambda m: m.isNotNull()))
    )
    broken = F.array(F.struct(F.lit(WHOLE_LINE).alias("column"), F.lit("OBJECT").alias("json_type"), F.lit(False).alias("too_large")))
    counted = (
        lines.select("value", F.explode(F.array(as_map(F.col("value")))).alias("_map"))
        # Only what could not be taken apart has to be looked at once more.
        .where(F.col("_map").isNotNull() | is_one_object(F.col("value")))
        .select(F.explode(F.when(F.col("_map").isNull(), broken).otherwise(pairs)).alias("_pair"))
        .where(F.col("_pair.json_type") != "VOID")
        .groupBy("_pair.column", "_pair.json_type", "_pair.too_large")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    wanted = small_frame(
        lines.sparkSession, list(kinds.items()), T.StructType([T.StructField(name, T.StringType()) for name in ("column", "kind")])
    )
    # A row for each key: what it occurs as, and what it is declared as, if at all.
    by_key = (
        counted.select("column", "json_type", "too_large", "rows", F.lit(None).cast("string").alias("kind"))
        .unionByName(wanted, allowMissingColumns=True)
        .groupBy("column")
        .agg(F.max("kind").alias("kind"), F.collect_list(F.when(F.col("json_type").isNotNull(), F.struct("json_type", "too_large", "rows"))).alias("seen"))
    )
    fitting = F.create_map(*[F.lit(x) for kind, types in _FITTING.items() for x in (kind, F.array(*map(F.lit, types)))])
    fits = lambda s: F.coalesce(F.array_contains(F.try_element_at(fitting, F.col("kind")), s["json_type"]), F.lit(False)) & ~s["too_large"]
    change = F.when(F.col("column") == WHOLE_LINE, UNREADABLE).when(F.col("kind").isNotNull(), TYPE_CHANGED).otherwise(ADDED)

    def deviation(json_type: Column, how: Column, rows: Column) -> Column:
        return F.struct(json_type.cast("string").alias("json_type"), how.alias("change"), rows.cast("long").alias("rows"))

    missing = F.array(deviation(F.lit(None), F.lit(MISSING), F.lit(0)))
    deviating = F.transform(F.filter("seen", lambda s: ~fits(s)), lambda s: deviation(s["json_type"], change, s["rows"]))
    found_out = by_key.select("column", F.inline(F.when(F.size("seen") == 0, missing).otherwise(deviating)))
    # An integer that is too large and a number with a fraction may be of one JSON type.
    return found_out.groupBy("column", "json_type", "change").agg(F.sum("rows").alias("rows"))
