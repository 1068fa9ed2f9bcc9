"""Warehouse properties: order keys, spine vs sparse growth, range vs function predicate."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from retailmart.operators import star as S
from retailmart.operators.star import ORDER_SK_KEY, add_order_sk
from retailmart.plans import analytics as A
from retailmart.plans.warehouse import star_from_testdata
from retailmart.sources import fixture


@pytest.fixture(scope="module")
def star(spark):
    return star_from_testdata(spark, SF_SMALL)


def test_order_sk_multi_bucket_equals_row_number(spark, star):
    fact = star["fact_orders"].drop("order_sk", "order_year")
    items = fixture.stg_order_items(spark, SF_SMALL)
    ours = add_order_sk(fact, sample_from=items, n_buckets=8)
    ref = fact.withColumn("order_sk", F.row_number().over(Window.orderBy(*ORDER_SK_KEY)).cast("long"))
    key = lambda r: (tuple(r[c] for c in ORDER_SK_KEY), r["order_sk"])
    # rows equal on the whole key are interchangeable: compare (key, number) multisets per key
    a, b = {}, {}
    for r in ours.collect():
        a.setdefault(key(r)[0], []).append(r["order_sk"])
    for r in ref.collect():
        b.setdefault(key(r)[0], []).append(r["order_sk"])
    assert {k: sorted(v) for k, v in a.items()} == {k: sorted(v) for k, v in b.items()}


def test_stored_order_sk_is_dense(star):
    r = star["fact_orders"].agg(F.min("order_sk").alias("lo"), F.max("order_sk").alias("hi"),
                                F.countDistinct("order_sk").alias("n"), F.count("*").alias("rows")).collect()[0]
    assert (r["lo"], r["hi"], r["n"]) == (1, r["rows"], r["rows"])


def test_spine_contains_sparse_months(star):
    sparse = {(r["year"], r["month"]): r["revenue"] for r in A.q03_mom_growth(star).collect()}
    spine = {(r["year"], r["month"]): r["revenue"] for r in A.q03b_mom_growth_spine(star, 1995, 2001).collect()}
    assert set(sparse) <= set(spine)
    assert all(spine[k] == v for k, v in sparse.items())
    assert all(v == 0.0 for k, v in spine.items() if k not in sparse)


def test_range_predicate_equals_year_function(star):
    a = A.fact_key_range(star, 1998).select("order_sk").collect()
    b = A.q12a_year_function(star, 1998).select("order_sk").collect()
    assert sorted(r[0] for r in a) == sorted(r[0] for r in b)
    assert len(a) > 0


def test_growth_min_base_blanks_small_bases(star):
    rows = A.q03b_mom_growth_spine(star, 1995, 2001, min_base=10**12).collect()
    assert all(r["growth_pct"] is None for r in rows)


def test_csv_landing_builds_the_same_fact(spark, star):
    """Land every staging table as CSV (text ids and timestamps), load it with the declared
    schemas and build the warehouse: the fact's business content equals the Parquet build."""
    from retailmart import schemas
    from retailmart.plans.warehouse import run_pipeline
    from retailmart.session import scratch_path
    from retailmart.sources import staging

    root = scratch_path(spark, "csv-landing")
    stg = fixture.staging(spark, SF_SMALL)
    raw_names = {v: k for k, v in schemas.STAGING_ALIASES["stg_products"].items()}
    for t, name in schemas.STAGING_FILES.items():
        df = stg[t]
        if t == "stg_products":
            df = df.toDF(*[raw_names.get(c, c) for c in df.columns])
        df.write.option("header", True).csv(f"{root}/{name}")
    loaded = staging.load_staging(spark, root)
    loaded["category_lookup"] = stg["category_lookup"]
    built = run_pipeline(spark, loaded, rate=fixture.FIXTURE_RATE)
    cols = ["order_id", "order_item_id", "date_sk", "order_status", "price_brl", "freight_brl", "price_inr",
            "freight_inr", "payment_value", "payment_type", "review_score", "delivery_days", "is_late_delivery"]
    a = built["fact_orders"].select(*[F.col(c).cast("string") for c in cols]).collect()
    b = star["fact_orders"].select(*[F.col(c).cast("string") for c in cols]).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_daily_sales_view_and_table(spark, star):
    from retailmart.session import scratch_path
    v = A.register_daily_sales_view(star)
    n = spark.sql("SELECT count(*) AS n FROM vw_daily_sales").collect()[0]["n"]
    assert n == v.count() > 0
    path = scratch_path(spark, "daily-sales")
    A.materialize_daily_sales(star, path)
    assert spark.read.parquet(path).count() == n


def test_star_views_for_sql(spark, star):
    from retailmart.plans.warehouse import register_star_views
    register_star_views(star)
    sql = spark.sql("""
        SELECT d.year, round(sum(f.price_inr), 2) AS revenue
        FROM fact_orders f JOIN dim_date d ON f.date_sk = d.date_sk
        WHERE f.order_status = 'delivered' GROUP BY d.year""")
    by_year = {r["year"]: float(r["revenue"]) for r in sql.collect()}
    q1 = A.q01_ytd_revenue(star).collect()
    last = {}
    for r in q1:
        last[r["year"]] = r["ytd_revenue"]
    assert by_year == last


def test_unique_order_keys_option(spark, star):
    from retailmart.plans.warehouse import run_pipeline
    built = run_pipeline(spark, fixture.staging(spark, SF_SMALL), rate=fixture.FIXTURE_RATE, order_keys="unique")
    f = built["fact_orders"]
    r = f.agg(F.count("*").alias("n"), F.countDistinct("order_sk").alias("d"),
              F.count("order_sk").alias("nn")).collect()[0]
    assert r["n"] == r["d"] == r["nn"] == star["fact_orders"].count()
    cols = [c for c in f.columns if c not in ("order_sk", "order_year")]
    assert (sorted(map(tuple, f.select(*cols).collect()), key=repr)
            == sorted(map(tuple, star["fact_orders"].select(*cols).collect()), key=repr))


def test_published_root_is_not_rebuilt_and_unfinished_root_is_not_read(spark, tmp_path):
    from retailmart.plans.warehouse import current_star, read_star, run_pipeline
    root, stg, registry = str(tmp_path / "star"), fixture.staging(spark, SF_SMALL), str(tmp_path / "registry")
    built = run_pipeline(spark, stg, root=root, rate=fixture.FIXTURE_RATE, registry=registry)
    lines = built["fact_orders"].count()
    with pytest.raises(FileExistsError):
        run_pipeline(spark, {**stg, "stg_customers": stg["stg_customers"].limit(3)}, root=root)
    # a second build that fails half way leaves no table, and the first one stays the current one
    text = F.concat(F.lit("at "), F.col("order_purchase_timestamp").cast("string"))
    spoiled = {**stg, "stg_orders": stg["stg_orders"].withColumn("order_purchase_timestamp", text)}
    with pytest.raises(Exception, match="purchase time cannot be read"):
        run_pipeline(spark, spoiled, root=str(tmp_path / "second"), registry=registry, gate=False, land=False,
                     date_start="1992-01-01", date_end="2002-12-31")
    assert [p.name for p in (tmp_path / "second").iterdir()] == []
    assert current_star(spark, registry).path == root and read_star(spark, root)["fact_orders"].count() == lines
    (tmp_path / "begun").mkdir()
    with pytest.raises(FileNotFoundError):
        read_star(spark, str(tmp_path / "begun"))


def test_unreadable_purchase_time_stops_the_fact(spark):
    stg = fixture.staging(spark, SF_SMALL)
    text = F.col("order_purchase_timestamp").cast("string")
    first = F.col("order_id") == stg["stg_orders"].agg(F.min("order_id")).first()[0]

    def fact(value):
        orders = stg["stg_orders"].withColumn("order_purchase_timestamp", F.when(first, F.lit(value)).otherwise(text))
        dims = [S.build_dim_customer(stg["stg_customers"]), S.build_dim_product(stg["stg_products"], stg.get("category_lookup")),
                S.build_dim_seller(stg["stg_sellers"])]
        return S.build_fact_orders({**stg, "stg_orders": orders}, *dims, with_order_sk=False)

    assert fact(None).where(first).count() == 0
    with pytest.raises(Exception, match="purchase time cannot be read"):
        fact("01/02/2018 10:00").collect()


def test_repeated_product_keeps_known_attributes(spark):
    rows = [("p", None, None, None), ("p", "toys", 3, 10), ("q", None, None, None)]
    got = S.build_dim_product(spark.createDataFrame(rows, "product_id string, category_name string, photos_qty int, weight_g int"),
                              spark.createDataFrame([("toys", "Toys")], "product_category_name string, product_category_name_english string"))
    assert [tuple(r)[1:] for r in got.orderBy("product_id").collect()] == [("p", "toys", "Toys", 3, 10), ("q", None, None, None, None)]
