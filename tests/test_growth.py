"""Plans whose cost must grow no faster than the tables: wide rows move once, no step is computed again."""

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from retailmart.operators import star as S
from retailmart.operators.keys import dense_surrogate_key
from retailmart.plans import operator_queries as O
from retailmart.plans.warehouse import star_from_testdata
from retailmart.sources import fixture


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbering_moves_rows_once_and_draws_no_bounds(spark):
    df = spark.range(3000).selectExpr("if(id % 50 = 0, null, id * 7919 % 101) AS a", "id % 13 AS b", "id AS c")
    ours = dense_surrogate_key(df, ["a", "b", "c"], "n", n_buckets=200, bucket_by=["a", "b"])
    plan = _plan(ours)
    assert "rangepartitioning" not in plan and plan.count("Exchange") == 1
    w = Window.orderBy(*[F.col(x).asc_nulls_first() for x in "abc"])
    assert {r.c: r.n for r in ours.collect()} == {r.c: r.n for r in df.withColumn("n", F.row_number().over(w)).collect()}


def test_wide_lines_are_shuffled_by_order_alone(spark):
    star, stg = star_from_testdata(spark, SF_SMALL), fixture.staging(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = S.build_fact_orders(stg, star["dim_customer"], star["dim_product"], star["dim_seller"], with_order_sk=False)
        assert re.search(r"SortMergeJoin \[(\w+)#", _plan(fact)).group(1) == "order_id"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_ntile_reads_written_counts(spark):
    files = O.win_ntile(spark, SF_SMALL).inputFiles()
    assert files and all("/customer_order_counts-" in f for f in files)
