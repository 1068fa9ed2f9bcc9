"""Small lookups: size-checked broadcast, category translation file, conversion rate."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalar import FALLBACK_RATE


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only after a bounded count proves the side small.

    ``limit(max_rows + 1).count()`` stops early on big inputs, so the check itself is
    cheap; above the bound the plan is left to AQE (sort-merge or runtime broadcast).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def scan_category_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Two-column translation CSV (header, possibly with a UTF-8 byte-order mark)."""
    raw = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    cols = [c.lstrip("﻿").strip().lower() for c in raw.columns]
    df = raw.toDF(*cols)
    names = [f.name for f in schemas.CATEGORY_LOOKUP.fields]
    return df.select(*[F.trim(F.col(n)).alias(n) for n in names])


def rate_lookup_fallback(spark: SparkSession, rates: DataFrame | None = None, ccy_from: str = "BRL",
                         ccy_to: str = "INR", fallback: Decimal = FALLBACK_RATE) -> DataFrame:
    """One-row frame with the conversion rate: the table's rate if present, else the fallback.

    Replaces the live HTTP lookup: the rate comes from a ``rates(ccy_from, ccy_to, rate)``
    table that any loader can fill.  Never a double: decimal(12,6).  Two different rates for
    the pair are an error, as nothing here says which one holds.  The result is a
    single row by construction (a global aggregate), so it can be broadcast safely.
    """
    fb = F.lit(Decimal(fallback)).cast("decimal(12,6)")
    if rates is None:
        return spark.range(1).select(fb.alias("rate"))
    found = (rates.where((F.col("ccy_from") == ccy_from) & (F.col("ccy_to") == ccy_to))
             .select(F.col("rate").cast("decimal(12,6)").alias("rate"))
             .agg(F.when(F.min("rate") != F.max("rate"), F.raise_error(F.lit("several rates for one pair of currencies")))
                  .otherwise(F.max("rate")).alias("rate")))
    return found.select(F.coalesce(F.col("rate"), fb).alias("rate"))
