"""Schemas and conformance of rows to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

EVENT_STRUCT = T.StructType([T.StructField(n, t) for n, t in (
    ("GET", T.StringType()), ("POST", T.StringType()), ("query", T.StringType()), ("user_id", T.LongType()), ("mode", T.StringType()),
    ("id", T.StringType()), ("currentTime", T.DoubleType()), ("new", T.LongType()), ("old", T.LongType()), ("problem", T.StringType()),
    ("problem_id", T.StringType()), ("answers", T.StringType()), ("success", T.StringType()), ("grade", T.DoubleType()),
    ("attempts", T.LongType()), ("max_grade", T.DoubleType()), ("speed", T.DoubleType()))])
CONTEXT = T.StructType([T.StructField(n, t) for n, t in (
    ("user_id", T.LongType()), ("path", T.StringType()), ("org_id", T.StringType()), ("session", T.StringType()), ("course_id", T.StringType()),
    ("module", T.StructType([T.StructField("display_name", T.StringType())])))])
TRACKING_LOG = T.StructType([T.StructField(n, t) for n, t in (
    ("course_id", T.StringType()), ("time", T.TimestampType()), ("username", T.StringType()), ("ip", T.StringType()),
    ("event_source", T.StringType()), ("event_type", T.StringType()), ("agent", T.StringType()), ("module_id", T.StringType()),
    ("page", T.StringType()), ("host", T.StringType()), ("event", T.StringType()), ("context", CONTEXT), ("event_struct", EVENT_STRUCT))])


def _coerce(col: Column, have: T.DataType, want: T.DataType) -> tuple[Column, Column]:
    """The value as the wanted type, and whether it cannot be: whole numbers must parse, fractions may be null."""
    if isinstance(want, T.StructType):
        if not isinstance(have, T.StructType):
            return F.lit(None).cast(want), col.isNotNull()
        inner, bad = [], F.lit(False)
        names = {f.name: f.dataType for f in have.fields}
        bad = F.lit(bool(set(names) - set(want.names))) & col.isNotNull()
        for f in want.fields:
            if f.name in names:
                v, b = _coerce(col[f.name], names[f.name], f.dataType)
                bad = bad | b
            else:
                v = F.lit(None).cast(f.dataType)
            inner.append(v.alias(f.name))
        return F.when(col.isNotNull(), F.struct(*inner)), bad
    if isinstance(want, T.ArrayType):
        if not isinstance(have, T.ArrayType):
            return F.lit(None).cast(want), col.isNotNull()
        value = F.transform(col, lambda x: _coerce(x, have.elementType, want.elementType)[0])
        bad = F.exists(col, lambda x: _coerce(x, have.elementType, want.elementType)[1])
        return value, F.coalesce(bad, F.lit(False))
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.lit(None).cast(want), col.isNotNull()
    value = col.try_cast(want)
    soft = isinstance(want, (T.DoubleType, T.FloatType, T.StringType))
    return value, F.lit(False) if soft else (col.isNotNull() & value.isNull())


def conform(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows in the given schema, and the rows that do not fit with the names of their bad fields.

    A column outside the schema is an error of the whole table.
    """
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"columns not in the schema: {unknown}")
    have = {f.name: f.dataType for f in df.schema.fields}
    values, reasons = [], []
    for f in schema.fields:
        if f.name not in have:
            values.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        v, bad = _coerce(F.col(f.name), have[f.name], f.dataType)
        values.append(v.alias(f.name))
        reasons.append(F.when(bad, F.lit(f.name)))
    marked = df.withColumn("bad_fields", F.array_compact(F.array(*reasons)))
    ok = marked.filter(F.size("bad_fields") == 0).select(*values)
    return ok, marked.filter(F.size("bad_fields") > 0)
