"""One schema for all shards of a corpus (key A1).

Shards of one corpus can differ: a column that only later shards have, or an
integer that grew to a long. Spark merges the footers of a set of files in one
parallel job where equal names have equal types; where they have not, the set
is cut in halves, each half merged, and the two schemas are widened here. So
a corpus of equal types costs one job, and one type change costs a job for
each halving.
"""

from __future__ import annotations

from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

#: Whole-number types from narrow to wide.
WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


class SchemaClash(ValueError):
    """Two shards hold a column in types without a common one."""


def widened(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds both, as the parquet reader can widen; None if
    there is none."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    if {type(a), type(b)} <= {T.FloatType, T.DoubleType, *map(type, WHOLE[:3])}:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        precision = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(precision, scale) if precision <= 38 else None
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = widened(a.elementType, b.elementType)
        return inner and T.ArrayType(inner, True)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        try:
            return merged(a, b)
        except SchemaClash:
            return None
    return None


def merged(a: T.StructType, b: T.StructType) -> T.StructType:
    """All columns of both, in the order of ``a`` and then ``b``; the ones
    that only one has, and those it holds null in, are nullable."""
    other = {f.name: f for f in b.fields}
    out = []
    for f in a.fields:
        kind = widened(f.dataType, other[f.name].dataType) if f.name in other else f.dataType
        if kind is None:
            raise SchemaClash(f.name)
        out.append(T.StructField(f.name, kind, True))
    own = {f.name for f in a.fields}
    return T.StructType(out + [T.StructField(f.name, f.dataType, True) for f in b.fields if f.name not in own])


def _of(spark: SparkSession, files: list[str]) -> T.StructType:
    if len(files) > 1:
        try:
            return spark.read.option("mergeSchema", "true").parquet(*files).schema
        except (PySparkException, Py4JJavaError) as exc:
            if "CANNOT_MERGE" not in str(exc):
                raise
    else:
        return spark.read.parquet(files[0]).schema
    half = len(files) // 2
    left, right = _of(spark, files[:half]), _of(spark, files[half:])
    try:
        return merged(left, right)
    except SchemaClash as clash:
        name = str(clash)
        if " " in name:  # named files already
            raise
        kinds = [s[name].dataType for s in (left, right)]
        where = [_first_with(spark, part, name, kind) for part, kind in zip((files[:half], files[half:]), kinds)]
        raise SchemaClash(f"column {name} is {kinds[0].simpleString()} in {where[0]} "
                          f"and {kinds[1].simpleString()} in {where[1]}") from None


def _first_with(spark: SparkSession, files: list[str], name: str, kind: T.DataType) -> str:
    """A file that holds the column in that type (the first found by halving)."""
    while len(files) > 1:
        half = len(files) // 2
        try:
            own = _of(spark, files[:half])
            left = name in own.names and own[name].dataType == kind
        except SchemaClash:
            left = True
        files = files[:half] if left else files[half:]
    return files[0]


def shard_schema(spark: SparkSession, target: str, file_glob: str | None = None) -> T.StructType | None:
    """Schema of all files of ``target`` (a folder, a file or a glob); None
    where a single file, or none, leaves nothing to reconcile."""
    reader = spark.read.schema("x INT")
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    files = sorted(unquote(f) for f in reader.parquet(target).inputFiles())  # given percent-encoded
    return _of(spark, files) if len(files) > 1 else None
