"""Cleaning of landed data: column names, NaN/inf, numeric coercion, declared types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case and strip every column name (a byte-order mark is stripped too)."""
    return df.toDF(*[c.replace("﻿", "").strip().lower() for c in df.columns])


def nan_inf_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN, +inf and -inf become NULL in floating-point columns."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = [c for c in (cols or df.columns) if c in floats]
    if not targets:
        return df
    bad = lambda c: F.isnan(F.col(c)) | F.col(c).isin(float("inf"), float("-inf"))
    return df.withColumns({c: F.when(bad(c), F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c))
                           for c in targets})


def coerce(col: str | Column, dtype: T.DataType) -> Column:
    """Value in the declared type; text that does not parse becomes NULL (never an error)."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.StringType):
        return c.cast("string")
    return c.try_cast(dtype)


def coerce_numeric(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """try_cast the named columns to their numeric types (unparsable -> NULL)."""
    return df.withColumns({c: coerce(c, t) for c, t in types.items() if c in df.columns})


def conform(df: DataFrame, schema: T.StructType, aliases: dict[str, str] | None = None) -> DataFrame:
    """Normalise names, apply known renames, check the header, cast to the declared schema.

    Missing declared columns are an error (a header that does not match the contract);
    extra columns are dropped.
    """
    df = normalize_columns(df)
    for src, dst in (aliases or {}).items():
        if src in df.columns and dst not in df.columns:
            df = df.withColumnRenamed(src, dst)
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"input is missing declared columns {missing}; has {df.columns}")
    df = nan_inf_to_null(df)
    return df.select(*[coerce(f.name, f.dataType).alias(f.name) for f in schema.fields])
