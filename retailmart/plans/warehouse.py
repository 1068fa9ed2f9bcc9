"""The warehouse pipeline: staging -> DQ gate -> dimensions -> fact, written as Parquet.

``run_pipeline`` builds all-or-nothing (a new root per run, published by a marker only when
every table is written); ``read_star`` opens published roots alone;
``star_from_testdata`` is the cached entry used by the query catalogue and the bench.
"""

from __future__ import annotations

import datetime as _dt
import logging
import time
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import star
from ..operators.star import as_date
from ..session import delete_path, path_exists, scratch_path
from ..sources import fixture
from ..sources.lookup import rate_lookup_fallback
from ..sources.sinks import sink_append, sink_replace_day, sink_staging_overwrite

STAR_TABLES = ("dim_date", "dim_customer", "dim_product", "dim_seller", "fact_orders")
MARKER = "_PUBLISHED"
RESULTS, JOB_LOG = "quality/dq_results", "quality/etl_job_log"  # under the root of a build
log = logging.getLogger(__name__)


@contextmanager
def _phase(name: str):
    t = time.perf_counter()
    yield
    log.info("pipeline phase %s: %.2fs", name, time.perf_counter() - t)


@dataclass
class Star:
    tables: dict[str, DataFrame]
    path: str | None = None
    calendar_days: int | None = None  # rows of dim_date (bounds its broadcast)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]


def _write_table(df: DataFrame, root: str, name: str) -> None:
    if name == "fact_orders":
        # Partitioned by order year: year-bounded queries prune whole directories.  No extra
        # shuffle: the numbered fact is already spread over tasks by order_id range.  Each
        # task's rows are sorted by (year, date key) -- the writer sorts by the partition
        # column anyway -- so Parquet row-group min/max on date_sk skip data for date
        # ranges inside a year (the role the reference's date index plays).
        df = df.withColumn("order_year", F.call_function("div", F.col("date_sk"), F.lit(10000)).cast("int"))
        (df.sortWithinPartitions("order_year", "date_sk")
         .write.mode("overwrite").partitionBy("order_year").parquet(f"{root}/{name}"))
    else:
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def _publish(spark: SparkSession, root: str) -> None:
    """Marker written last: a root without it is an unfinished build and is never read."""
    spark.createDataFrame([(_dt.datetime.now().isoformat(),)], "published string") \
        .coalesce(1).write.mode("overwrite").json(f"{root}/{MARKER}")


def _land(stg: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Staging written once as Parquet, so that later phases neither parse nor join it again."""
    def write(item):
        name, df = item
        sink_staging_overwrite(df, f"{root}/staging/{name}")
        return name, df.sparkSession.read.parquet(f"{root}/staging/{name}")
    with ThreadPoolExecutor(max_workers=max(1, len(stg))) as pool:
        return dict(pool.map(write, stg.items()))


def _gate(spark: SparkSession, stg: dict[str, DataFrame], root: str, when: _dt.datetime) -> None:
    """Rules evaluated once; results and job-log row are stored whether or not the gate stops."""
    from ..quality import rule_table as RT
    rules = RT.rules_frame(spark)
    sink_replace_day(RT.evaluate_rules(stg, rules, when), f"{root}/{RESULTS}")
    results = spark.read.schema(schemas.DQ_RESULTS).parquet(f"{root}/{RESULTS}")
    sink_append(RT.dq_monitor(results, rules, when.date(), when), f"{root}/{JOB_LOG}")
    for line in RT.dq_gate(results, rules, when.date()):
        log.info(line)


def run_pipeline(spark: SparkSession, stg: dict[str, DataFrame], root: str | None = None,
                 rate: Decimal | None = None, date_start=None, date_end=None, lookup: DataFrame | None = None,
                 gate: bool = True, check_time: _dt.datetime | None = None, order_keys: str = "dense",
                 rates: DataFrame | None = None, land: bool = True, registry: str | None = None) -> Star:
    """Rate -> landing -> DQ gate -> dimensions (written) -> fact (written) -> publish.

    The rate is ``rate``, else that of the ``rates`` table, else the fallback.  Staging is
    landed as Parquet under the root (``land=False`` for frames that already are tables), the
    gate's results and job log are stored there, and a HIGH failure stops the build before any
    table is written.  ``registry`` names a table to which the published root is added.

    Dimensions are written first and the fact joins the written tables, so their keys are
    computed once and the joins see real sizes.  The fact before numbering is written as
    Parquet under ``spark.checkpoint.dir`` so the numbering does not recompute the joins.
    Everything goes to a new root, published by a marker only when complete (all-or-nothing,
    nothing is cleared before the new build exists); the tables of a build that failed are
    removed, its quality results stay.  Without explicit bounds the calendar covers the whole
    years of the purchase dates.

    ``order_keys="dense"`` numbers the fact 1..N in business-key order (IDENTITY
    semantics; one extra sort of the fact).  ``"unique"`` gives every line a unique but not
    dense id in the same pass that writes the fact -- for consumers that only need a row
    identity, it saves the lineage-cut write, the counting pass and the numbering sort.
    """
    if order_keys not in ("dense", "unique"):
        raise ValueError("order_keys must be 'dense' or 'unique'")
    root = root or scratch_path(spark, "star")
    if path_exists(spark, f"{root}/{MARKER}"):
        # tables replaced one by one under the old marker would mix two builds
        raise FileExistsError(f"{root} holds a published star; build into a new root")
    if rate is None:
        rate = rate_lookup_fallback(spark, rates).first()["rate"]
    pre_key = scratch_path(spark, "fact-prekey")
    try:
        if land:
            with _phase("landing"):
                stg = _land(stg, root)
        if gate:
            with _phase("gate"):
                _gate(spark, stg, root, check_time or _dt.datetime.now())
        days = _write_star(spark, stg, root, pre_key, rate, date_start, date_end, lookup, order_keys)
    except BaseException:
        for name in (*STAR_TABLES, *(["staging"] if land else [])):
            delete_path(spark, f"{root}/{name}")
        raise
    finally:
        delete_path(spark, pre_key)
    _publish(spark, root)
    if registry is not None:
        sink_append(spark.createDataFrame([(root, _dt.datetime.now())], "root string, published timestamp_ntz"), registry)
    return read_star(spark, root, calendar_days=days)


def _write_star(spark: SparkSession, stg: dict[str, DataFrame], root: str, pre_key: str, rate: Decimal,
                date_start, date_end, lookup: DataFrame | None, order_keys: str) -> int:
    """Write the five tables; returns the number of calendar days."""
    if date_start is None or date_end is None:
        with _phase("calendar range"):
            lo, hi = star.calendar_range(stg["stg_orders"])
        date_start, date_end = date_start or lo, date_end or hi
    lk = lookup if lookup is not None else stg.get("category_lookup")
    builders = {
        "dim_date": lambda: star.build_dim_date(spark, date_start, date_end),
        "dim_customer": lambda: star.build_dim_customer(stg["stg_customers"]),
        "dim_product": lambda: star.build_dim_product(stg["stg_products"], lk),
        "dim_seller": lambda: star.build_dim_seller(stg["stg_sellers"]),
    }
    # The four dimensions are independent: their jobs are submitted concurrently.
    with _phase("dimensions"), ThreadPoolExecutor(max_workers=len(builders)) as pool:
        for f in [pool.submit(lambda n=n, b=b: _write_table(b(), root, n)) for n, b in builders.items()]:
            f.result()
    written = {n: spark.read.parquet(f"{root}/{n}") for n in builders}
    days = (as_date(date_end) - as_date(date_start)).days + 1
    fact = star.build_fact_orders(stg, written["dim_customer"], written["dim_product"], written["dim_seller"],
                                  rate, with_order_sk=False)
    if order_keys == "unique":
        with _phase("fact join + write"):
            # unique within the committed output: partition index in the high bits
            keyed = fact.select((F.monotonically_increasing_id() + 1).alias("order_sk"), *fact.columns)
            _write_table(keyed, root, "fact_orders")
        return days
    # Lineage cut: the joined fact is written once as a columnar table in the shared
    # checkpoint folder; counting and numbering then read only the columns they need.
    with _phase("fact join"):
        fact.write.parquet(pre_key)
    with _phase("fact keys"):
        keyed = star.add_order_sk(spark.read.parquet(pre_key))  # sampled from the written copy: two columns of it
    with _phase("fact write"):
        _write_table(keyed, root, "fact_orders")
    return days


def current_star(spark: SparkSession, registry: str) -> Star:
    """The star published last, by the table of published roots (one row a build)."""
    row = spark.read.parquet(registry).agg(F.max_by("root", "published").alias("root")).first()
    return read_star(spark, row["root"])


def register_star_views(star: Star) -> list[str]:
    """Expose the star to SQL users: one temp view per table (same names as the tables)."""
    for name, df in star.tables.items():
        df.createOrReplaceTempView(name)
    return list(star.tables)


def read_star(spark: SparkSession, root: str, calendar_days: int | None = None) -> Star:
    if not path_exists(spark, f"{root}/{MARKER}"):
        raise FileNotFoundError(f"{root} holds no published star (its build has not finished)")
    tables = {n: spark.read.parquet(f"{root}/{n}") for n in STAR_TABLES}
    if calendar_days is None:
        calendar_days = tables["dim_date"].count()  # footer-only count of a small table
    return Star(tables, root, calendar_days)


_CACHE: dict[tuple[str, str], Star] = {}


def staging_from_testdata(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return fixture.staging(spark, sf_dir)


def star_from_testdata(spark: SparkSession, sf_dir: str) -> Star:
    """Build the star once per (application, data set) from the fixture and keep it."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    hit = _CACHE.get(key)
    if hit is not None:
        return hit
    stg = staging_from_testdata(spark, sf_dir)
    built = run_pipeline(spark, stg, rate=fixture.FIXTURE_RATE)
    _CACHE[key] = built
    return built
