"""Course and module key expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def plain_course_id(col: Column) -> Column:
    """``course-v1:Org+Num+Run`` as ``Org/Num/Run``; other ids unchanged."""
    return F.when(col.startswith("course-v1:"), F.translate(F.regexp_replace(col, "^course-v1:", ""), "+", "/")).otherwise(col)


def plain_module_id(col: Column) -> Column:
    """``block-v1:Org+Num+Run+type@T+block@X`` as ``i4x://Org/Num/T/X``; other ids unchanged."""
    pattern = r"^block-v1:([^+]+)\+([^+]+)\+([^+]+)\+type@([^+]+)\+block@(.*)$"
    return F.when(col.rlike(pattern), F.regexp_replace(col, pattern, "i4x://$1/$2/$4/$5")).otherwise(col)


def opaque_course_id(col: Column) -> Column:
    """``Org/Num/Run`` as ``course-v1:Org+Num+Run``; ids already opaque unchanged."""
    return F.when(col.startswith("course-v1:"), col).otherwise(F.concat(F.lit("course-v1:"), F.translate(col, "/", "+")))


def dataset_name(col: Column) -> Column:
    """A course id with characters allowed in table names: ``/`` becomes ``__``, ``.`` and ``-`` become ``_``."""
    return F.translate(F.replace(col, F.lit("/"), F.lit("__")), ".-", "__")


def normalize_keys(df: DataFrame, course_cols: list[str] = (), module_cols: list[str] = ()) -> DataFrame:
    """Replace opaque ids by plain ones in the named columns."""
    cols = {c: plain_course_id(F.col(c)) for c in course_cols}
    cols.update({c: plain_module_id(F.col(c)) for c in module_cols})
    return df.withColumns(cols) if cols else df


def ip_number(col: Column) -> Column:
    """Dotted IPv4 address as a number; null when it is not one."""
    parts = F.split(col, r"\.")
    num = F.lit(0).cast("long")
    for i in range(4):
        num = num * 256 + F.get(parts, F.lit(i)).try_cast("long")
    return F.when(col.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), num)
