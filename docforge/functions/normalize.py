"""Value normalisation at the document edge (PRJ-5).

Date-times become ATOM text (``2024-01-31T10:00:00+00:00``), arrays are
normalised element by element, structs and maps value by value, everything else
passes through. The rule is
schema-driven: the Spark type of each column decides the expression, so the
whole projection stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ATOM layout (RFC 3339, seconds precision, numeric offset).
ATOM_LOCAL = "yyyy-MM-dd'T'HH:mm:ss"
ATOM_ZONED = "yyyy-MM-dd'T'HH:mm:ssxxx"


def atom(col: Column, dtype: T.DataType) -> Column:
    """Format a timestamp/date column as ATOM text.

    ``TIMESTAMP_NTZ`` and ``DATE`` carry no zone and are read as UTC (the
    offset is the literal ``+00:00``, independent of the session zone);
    zoned timestamps use the session zone's offset.
    """
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return F.concat(F.date_format(col, ATOM_LOCAL), F.lit("+00:00"))
    return F.date_format(col, ATOM_ZONED)


def normalize_value(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return atom(col, dtype)
    if isinstance(dtype, T.ArrayType):
        inner = dtype.elementType
        if _needs_normalising(inner):
            return F.transform(col, lambda x: normalize_value(x, inner))
    if isinstance(dtype, T.StructType) and _needs_normalising(dtype):
        fields = [normalize_value(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.MapType) and _needs_normalising(dtype.valueType):
        return F.transform_values(col, lambda _, v: normalize_value(v, dtype.valueType))
    return col


def _needs_normalising(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return True
    if isinstance(dtype, T.ArrayType):
        return _needs_normalising(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_needs_normalising(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.MapType):
        return _needs_normalising(dtype.valueType)
    return False


def normalize_columns(df, exclude: tuple[str, ...] = ()):
    """Apply :func:`normalize_value` to every column of ``df`` (one projection)."""
    cols = []
    for f in df.schema.fields:
        if f.name in exclude or not _needs_normalising(f.dataType):
            cols.append(F.col(f"`{f.name}`"))
        else:
            cols.append(normalize_value(F.col(f"`{f.name}`"), f.dataType).alias(f.name))
    return df.select(*cols)
