"""Order-sensitive operators: dense keys and NTILE without a single-partition window."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from retailmart.operators.keys import bucket_expr, dense_surrogate_key, ntile_global, ntile_histogram, split_points


def _compare_rank(spark, rows, schema, order_by, n_buckets):
    df = spark.createDataFrame(rows, schema)
    ours = dense_surrogate_key(df, order_by, "k", n_buckets=n_buckets)
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    ref = df.withColumn("k", F.row_number().over(w).cast("long"))
    key = order_by
    a = sorted(((tuple(r[c] for c in key), r["k"]) for r in ours.collect()), key=repr)
    b = sorted(((tuple(r[c] for c in key), r["k"]) for r in ref.collect()), key=repr)
    return a, b


def test_dense_key_equals_row_number_int(spark):
    rows = [(i * 7919 % 1000, f"x{i}") for i in range(1000)]
    for nb in (1, 3, 8, 64):
        a, b = _compare_rank(spark, rows, "k1 int, s string", ["k1"], nb)
        assert a == b


def test_dense_key_strings_with_nulls(spark):
    rows = [(None if i % 17 == 0 else f"id{i * 31 % 500:04d}",) for i in range(500)]
    a, b = _compare_rank(spark, rows, "s string", ["s"], 8)
    # rows that tie on the key may take their numbers in any order: compare per value
    def per_value(pairs):
        out = {}
        for key, k in pairs:
            out.setdefault(key, []).append(k)
        return {key: sorted(ks) for key, ks in out.items()}
    assert per_value(a) == per_value(b)
    assert sorted(x[1] for x in a) == list(range(1, 501))


def test_dense_key_composite(spark):
    rows = [(i % 13, i % 7, i) for i in range(700)]
    a, b = _compare_rank(spark, rows, "a int, b int, c int", ["a", "b", "c"], 16)
    assert a == b


def test_dense_key_is_stable_across_partitions(spark):
    rows = [(i * 104729 % 5000,) for i in range(5000)]
    df = spark.createDataFrame(rows, "k long")
    k1 = {r["k"]: r["sk"] for r in dense_surrogate_key(df.repartition(3), ["k"], "sk", n_buckets=8).collect()}
    k2 = {r["k"]: r["sk"] for r in dense_surrogate_key(df.repartition(11), ["k"], "sk", n_buckets=5).collect()}
    assert k1 == k2
    assert sorted(k1.values()) == list(range(1, 5001))


def test_bucket_expr_preserves_order(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    splits = split_points(df, ["k"], 10)
    b = df.withColumn("b", bucket_expr(df, ["k"], splits)).orderBy("k").collect()
    bs = [r["b"] for r in b]
    assert bs == sorted(bs)
    assert max(bs) == len(splits)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=30), min_size=1, max_size=120), st.integers(1, 7))
def test_ntile_global_equals_spark_ntile(spark, values, k):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, id int")
    ours = {r["id"]: r["t"] for r in ntile_global(df, ["v", "id"], k, "t", n_buckets=4).collect()}
    ref = {r["id"]: r["t"] for r in df.withColumn("t", F.ntile(k).over(Window.orderBy("v", "id"))).collect()}
    assert ours == ref


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=9), min_size=1, max_size=150), st.integers(1, 6))
def test_ntile_histogram_equals_row_level(spark, values, k):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, id int")
    hist = df.groupBy("v").agg(F.count("*").alias("n"))
    ours = {r["bucket"]: (r["rows"], r["value_sum"]) for r in ntile_histogram(hist, "v", "n", k).collect()}
    tiles = df.withColumn("t", F.ntile(k).over(Window.orderBy("v", "id")))
    ref = {r["t"]: (r["rows"], r["s"]) for r in
           tiles.groupBy("t").agg(F.count("*").alias("rows"), F.sum("v").alias("s")).collect()}
    assert ours == ref
