"""Type names, generated schemas and schema conformance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Type names accepted in job settings. Decimals without a stated
# precision are (24,6).
TYPE_NAMES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "byte": T.ByteType(),
    "byte[]": T.BinaryType(),
    "short": T.ShortType(),
    "float": T.FloatType(),
    "java.math.bigdecimal": T.DecimalType(24, 6),
    "bigdecimal": T.DecimalType(24, 6),
    "java.sql.date": T.DateType(),
    "date": T.DateType(),
    "java.sql.timestamp": T.TimestampType(),
    "timestamp": T.TimestampType(),
}


def type_by_name(name: str) -> T.DataType:
    try:
        return TYPE_NAMES[name.strip().lower()]
    except KeyError:
        raise ValueError(f"unsupported type name: {name!r}") from None


def cast_by_name(col: Column, name: str) -> Column:
    """Cast to a named type; dirty input becomes NULL."""
    return col.try_cast(type_by_name(name))


def schema_from_names(names: str, dtype: T.DataType | None = None) -> T.StructType:
    """Schema with one nullable column per blank-separated word."""
    return T.StructType([T.StructField(n, dtype or T.StringType()) for n in names.split()])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Reorder and cast columns to ``schema`` by name; missing nullable columns become NULL."""
    return df.to(schema)


def as_text(col: Column, dtype: T.DataType) -> Column:
    """Text form of a typed value: plain decimals, UTF-8 bytes, ISO dates."""
    if isinstance(dtype, T.BinaryType):
        return F.decode(col, "UTF-8")
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(col)
    return col.cast("string")
