"""Landing: the raw CSV files into typed staging tables.

Every file is read as text with its header, its column names normalised, checked
against the declared schema and cast with ``try_cast`` (bad values become NULL, as the
lenient client-side cleaning did).  The scan is distributed; nothing passes through the
driver.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..functions.cleaning import conform
from . import records

log = logging.getLogger(__name__)


# Tables with free-text fields whose quoted values may span lines: their records are put
# together from ranges of the file (``records``), which costs a shuffle of the text.
MULTILINE_TABLES = frozenset({"stg_reviews"})


def scan_csv_staging(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One staging table from a header CSV file (or directory of files).

    RFC 4180 quoting: fields in double quotes, a doubled quote inside is a literal quote.
    """
    if table in MULTILINE_TABLES:
        raw = records.scan_csv_records(spark, path)
    else:
        raw = (spark.read.option("header", True).option("inferSchema", False)
               .option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"').csv(path))
    return conform(raw, schemas.STAGING[table], schemas.STAGING_ALIASES.get(table))


def empty_staging(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schemas.STAGING[table])


def scan_missing_optional(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, bool]:
    """Like ``scan_csv_staging``, but an absent file gives an empty typed table and a warning."""
    try:
        return scan_csv_staging(spark, path, table), True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        log.warning("file not found: %s (table %s left empty)", path, table)
        return empty_staging(spark, table), False


def load_staging(spark: SparkSession, data_dir: str, files: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """All staging tables from ``data_dir`` (missing files: empty tables)."""
    files = files or schemas.STAGING_FILES
    out = {}
    for table, name in files.items():
        out[table], _ = scan_missing_optional(spark, f"{data_dir.rstrip('/')}/{name}", table)
    return out
