"""Landing and sinks: CSV scan with declared schema, BOM, missing files, replace-day."""

import datetime as dt
from decimal import Decimal

import pytest

from retailmart.session import scratch_path
from retailmart.sources import lookup, sinks, staging


def test_category_lookup_with_bom(spark, tmp_path):
    p = tmp_path / "cats.csv"
    p.write_bytes("﻿product_category_name,product_category_name_english\nbeleza,beauty\nx,y\n".encode("utf-8"))
    df = lookup.scan_category_lookup(spark, str(p))
    assert df.columns == ["product_category_name", "product_category_name_english"]
    assert sorted(tuple(r) for r in df.collect()) == [("beleza", "beauty"), ("x", "y")]


def test_csv_scan_declared_types_and_coercion(spark, tmp_path):
    p = tmp_path / "items.csv"
    p.write_text(" Order_ID ,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
                 "o1,1,p1,s1,2018-01-01 10:00:00,10.50,1.25\n"
                 "o2,x,p2,s2,bad,NaN,inf\n")
    df = staging.scan_csv_staging(spark, str(p), "stg_order_items")
    rows = {r["order_id"]: r for r in df.collect()}
    assert rows["o1"]["price"] == Decimal("10.50") and rows["o1"]["order_item_id"] == 1
    assert rows["o2"]["order_item_id"] is None and rows["o2"]["price"] is None and rows["o2"]["freight_value"] is None


def test_header_mismatch_is_an_error(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        staging.scan_csv_staging(spark, str(p), "stg_sellers")


def test_missing_file_gives_empty_table(spark, tmp_path):
    df, present = staging.scan_missing_optional(spark, str(tmp_path / "nope.csv"), "stg_reviews")
    assert not present and df.count() == 0 and "review_score" in df.columns


def test_replace_day_is_idempotent(spark):
    path = scratch_path(spark, "replace-day-test")
    day1 = spark.createDataFrame([(1, dt.date(2026, 1, 1)), (2, dt.date(2026, 1, 1))], "v int, check_date date")
    day2 = spark.createDataFrame([(3, dt.date(2026, 1, 2))], "v int, check_date date")
    sinks.sink_replace_day(day1, path)
    sinks.sink_replace_day(day2, path)
    sinks.sink_replace_day(day1.where("v = 1"), path)   # re-run of day 1 replaces only day 1
    got = sorted((r["v"], str(r["check_date"])) for r in spark.read.parquet(path).collect())
    assert got == [(1, "2026-01-01"), (3, "2026-01-02")]


def test_append_keeps_history(spark):
    path = scratch_path(spark, "append-test")
    df = spark.createDataFrame([(1,)], "v int")
    sinks.sink_append(df, path)
    sinks.sink_append(df, path)
    assert spark.read.parquet(path).count() == 2


def test_rate_lookup_prefers_table_then_fallback(spark):
    from retailmart import schemas
    rates = spark.createDataFrame([("BRL", "INR", Decimal("16.25")), ("USD", "INR", Decimal("83.1"))], schemas.RATES)
    assert lookup.rate_lookup_fallback(spark, rates).collect()[0]["rate"] == Decimal("16.250000")
    empty = spark.createDataFrame([], schemas.RATES)
    assert lookup.rate_lookup_fallback(spark, empty).collect()[0]["rate"] == Decimal("18.500000")
    assert lookup.rate_lookup_fallback(spark).collect()[0]["rate"] == Decimal("18.500000")


def test_pipeline_gate_stops_on_dirty_staging(spark):
    from conftest import SF_SMALL
    from retailmart.plans.warehouse import JOB_LOG, RESULTS, STAR_TABLES, run_pipeline
    from retailmart.quality.rule_table import DataQualityGateError
    from retailmart.session import path_exists
    from retailmart.sources import fixture
    root = scratch_path(spark, "gated")
    with pytest.raises(DataQualityGateError):
        run_pipeline(spark, fixture.staging_dirty(spark, SF_SMALL), root, check_time=dt.datetime(2026, 1, 1, 6, 0, 0))
    # results and job log stay, tables and landed copies do not
    assert spark.read.parquet(f"{root}/{RESULTS}").count() == 9
    assert [r["status"] for r in spark.read.parquet(f"{root}/{JOB_LOG}").collect()] == ["FAIL"]
    assert not any(path_exists(spark, f"{root}/{n}") for n in (*STAR_TABLES, "staging"))


def test_review_comments_with_newlines_and_quotes(spark, tmp_path):
    p = tmp_path / "reviews.csv"
    p.write_text('review_id,order_id,review_score,review_comment_title,review_comment_message,'
                 'review_creation_date,review_answer_timestamp\n'
                 'r1,o1,5,"Great","line one\nline two, with comma and ""quotes""",2018-01-01 00:00:00,2018-01-02 10:00:00\n'
                 'r2,o2,1,,plain,2018-01-03 00:00:00,\n')
    rows = {r["review_id"]: r for r in staging.scan_csv_staging(spark, str(p), "stg_reviews").collect()}
    assert len(rows) == 2
    assert rows["r1"]["review_comment_message"] == 'line one\nline two, with comma and "quotes"'
    assert rows["r2"]["review_score"] == 1 and rows["r2"]["review_comment_title"] is None


def test_reviews_in_many_files(spark, tmp_path):
    head = "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
    for i in range(3):
        (tmp_path / f"part-{i}.csv").write_text(head + "".join(f'r{i}-{j},o{j},5,,"line one\nline ""{j}""",2018-01-01 00:00:00,2018-01-02 00:00:00\n' for j in range(20)))
    df = staging.scan_csv_staging(spark, str(tmp_path), "stg_reviews")
    rows = df.collect()
    assert {r["review_id"]: r["review_comment_message"] for r in rows} == {f"r{i}-{j}": f'line one\nline "{j}"' for i in range(3) for j in range(20)}
