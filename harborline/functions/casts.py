"""Typed projections into the table schemas.

Two regimes, as the loads need them:
  * strict  (statistics): a value that does not fit fails the job (ANSI cast);
  * lenient (master data): null, NaN or an unconvertible value becomes null.
Both are a single `select`, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.schemas import RENAMES

_SOURCE_NAME = {v: k for k, v in RENAMES.items()}


def source_name(table_column: str) -> str:
    return _SOURCE_NAME.get(table_column, table_column)


def _source(df: DataFrame, table_column: str) -> str | None:
    """Name of the input column feeding `table_column` (case-insensitive)."""
    names = {c.lower(): c for c in df.columns}
    for cand in (table_column, source_name(table_column)):
        if cand.lower() in names:
            return names[cand.lower()]
    return None


def strict(df: DataFrame, table: T.StructType, optional: tuple[str, ...] = ()) -> DataFrame:
    """Project to `table`. A value that does not fit raises, and so does an
    absent column unless `optional` names it (then it becomes null). Variants
    are cast from whatever they hold: 12.0 and "7" are integers, "abc" fails."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for f in table.fields:
        src, kind = _source(df, f.name), f.dataType.simpleString()
        if src is None:
            if f.name not in optional:
                raise ValueError(f"no column for {f.name}; columns: {', '.join(df.columns)}")
            value = f"CAST(NULL AS {kind})"
        elif isinstance(types[src], T.VariantType):
            value = f"variant_get(`{src}`, '$', '{kind}')"
        else:
            value = f"CAST(`{src}` AS {kind})"
        exprs.append(f"{value} AS `{f.name}`")
    return df.selectExpr(*exprs)


def strict_columns(df: DataFrame, table: T.StructType) -> list[str]:
    """Columns of `table` that `strict` finds in `df`."""
    return [f.name for f in table.fields if _source(df, f.name) is not None]


def _lenient_from_variant(v: str, dtype: T.DataType) -> str:
    if isinstance(dtype, T.StringType):
        return f"try_variant_get({v}, '$', 'string')"
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        # number -> truncated; integer text -> parsed; any other text -> null
        return f"CAST(try_variant_get({v}, '$', 'bigint') AS {dtype.simpleString()})"
    if isinstance(dtype, T.DoubleType):
        d = f"try_variant_get({v}, '$', 'double')"
        # NaN -> null applies to numbers only; the text "NaN" stays NaN
        return (f"CASE WHEN isnan({d}) AND schema_of_variant({v}) <> 'STRING' "
                f"THEN CAST(NULL AS DOUBLE) ELSE {d} END")
    return f"try_variant_get({v}, '$', '{dtype.simpleString()}')"


def _lenient_from_column(c: str, src_type: T.DataType, dtype: T.DataType) -> str:
    if isinstance(dtype, T.StringType):
        return f"CAST({c} AS STRING)"
    if isinstance(src_type, (T.FloatType, T.DoubleType)):
        c = f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END"
    return f"try_cast({c} AS {dtype.simpleString()})"


def lenient(df: DataFrame, table: T.StructType, key: str = "portid",
            null_key: str = "drop") -> DataFrame:
    """Project to `table` turning null/NaN/unconvertible values into null.

    null_key: "drop" removes rows without a key (default); "text" keeps them
    under the text key 'None', as a str() of a missing value would.
    """
    schema = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for f in table.fields:
        src = _source(df, f.name)
        if src is None:
            e = f"CAST(NULL AS {f.dataType.simpleString()})"
        elif isinstance(schema[src], T.VariantType):
            e = _lenient_from_variant(f"`{src}`", f.dataType)
        else:
            e = _lenient_from_column(f"`{src}`", schema[src], f.dataType)
        if f.name == key and null_key == "text":
            e = f"coalesce({e}, 'None')"
        exprs.append(f"{e} AS `{f.name}`")
    out = df.selectExpr(*exprs)
    if null_key == "drop":
        out = out.where(F.col(key).isNotNull())
    return out
