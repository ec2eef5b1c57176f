import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException

from martloom.schemas import TABLES
from martloom.session import scratch_path
from martloom.sources.csv_files import (
    CORRUPT, REJECTED, infer_and_cast, nan_to_null, read_csv_by_name, read_full_csv, read_increment_csv, split_rejects,
)
from martloom.sources.landing import Landing, expected_increments, files_available, increments_available
from tests.conftest import rows


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


@pytest.fixture
def landing(spark):
    return Landing(scratch_path(spark, "landing"))


def test_headers_are_matched_by_name(spark, landing):
    put(landing.path("2024-01-01", "user_activity_log"), "id,date_time,action_id,customer_id,quantity\n1,2024-01-01 10:00:00,3,7,1\n")
    put(landing.path("2024-01-02", "user_activity_log"),
        "action,quantity,customer_id,action_id,date_time,uniq_id\nview,2,8,4,2024-01-02 11:00:00,u1\n")
    df = read_increment_csv(spark, landing, "user_activity_log", ["2024-01-01", "2024-01-02"])
    assert rows(df, "increment", "uniq_id", "action_id", "customer_id", "quantity", "action") == [
        ("2024-01-01", None, 3, 7, 1, None), ("2024-01-02", "u1", 4, 8, 2, "view")]
    assert "id" not in df.columns


def test_default_is_per_file(spark, landing):
    head = "date_time,city_id,city_name,customer_id,first_name,last_name,item_id,item_name,quantity,payment_amount"
    line = "2024-01-01,1,Rome,7,A,B,3,ball,1,9.99"
    put(landing.path("a", "user_order_log"), f"{head}\n{line}\n")
    put(landing.path("b", "user_order_log"), f"{head},status\n{line},refunded\n{line},\n")
    df = read_increment_csv(spark, landing, "user_order_log", ["a", "b"], defaults={"status": "shipped"})
    assert rows(df, "increment", "status") == [("a", "shipped"), ("b", "refunded"), ("b", None)]


def test_part_file_with_another_header_stops(spark):
    path = scratch_path(spark, "mixed")
    put(f"{path}/part-0.csv", "a,b\n1,2\n")
    put(f"{path}/part-1.csv", "b,a\n3,4\n")
    with pytest.raises(Exception, match="header"):
        read_csv_by_name(spark, path).select("a", "b").collect()


def test_quotes_short_and_long_lines(spark):
    path = scratch_path(spark, "lines") + "/x.csv"
    put(path, 'a,b,c\n"1,5","say ""hi""",z\n2\n3,4,5,6\n\n7,8,9\n')
    df = read_csv_by_name(spark, path)
    assert rows(df, "a", "b", "c", CORRUPT) == sorted([
        ("1,5", 'say "hi"', "z", None), ("2", None, None, None), ("3", "4", "5", "3,4,5,6"), ("7", "8", "9", None)], key=repr)


def test_na_tokens_and_float_integers(spark):
    path = scratch_path(spark, "types") + "/customer_research.csv"
    put(path, "date_id,category_id,geo_id,sales_qty,sales_amt,extra\n20240105,5.0,NA,2.5,10.005,x\n"
              "2024-01-06 01:02:03,,n/a,-2.5,1e2,x\n20240107.0,<NA>,7,null,None,x\n")
    df = read_full_csv(spark, path, "customer_research")
    assert rows(df) == sorted([
        (dt.datetime(2024, 1, 5), 5, None, 3, Decimal("10.01")),
        (dt.datetime(2024, 1, 6, 1, 2, 3), None, None, -3, Decimal("100.00")),
        (dt.datetime(2024, 1, 7), None, 7, None, None)], key=repr)


def test_malformed_values_stop_or_are_set_aside(spark):
    path = scratch_path(spark, "bad") + "/customer_research.csv"
    put(path, "date_id,category_id,geo_id,sales_qty,sales_amt\n20240105,five,1,1,1\n20240106,6,1,1,1\n20240107,7,1,1,1,9\n")
    with pytest.raises(Exception, match="category_id: not a int: five"):
        read_full_csv(spark, path, "customer_research").collect()
    flagged = read_full_csv(spark, path, "customer_research", on_error="flag")
    good, bad = split_rejects(flagged)
    assert rows(good, "category_id") == [(6,)]
    assert rows(bad, REJECTED) == [(["_corrupt_record"],), (["category_id"],)]


def test_surplus_field_stops(spark):
    path = scratch_path(spark, "surplus") + "/customer_research.csv"
    put(path, "date_id,category_id,geo_id,sales_qty,sales_amt\n20240107,7,1,1,1,9\n")
    with pytest.raises(Exception, match="more fields than the header"):
        read_full_csv(spark, path, "customer_research").collect()


def test_surplus_field_stops_whatever_is_read(spark):
    path = scratch_path(spark, "full") + "/user_activity_log.csv"
    put(path, "date_time,action_id,customer_id,quantity\n2024-01-01 10:00:00,3,7,1\n2024-01-01 10:00:00,3,7,1,9\n")
    for column in ("quantity", "date_time"):
        with pytest.raises(Exception, match="more fields than the header"):
            read_full_csv(spark, path, "user_activity_log").select(column).collect()


def test_quoted_line_breaks(spark):
    path = scratch_path(spark, "full") + "/price_log.csv"
    put(path, 'datetime,category_id,category_name,item_id,price\n2024-01-01,1,"two\nlines",3,4.5\n')
    got = read_full_csv(spark, path, "price_log", multiline=True)
    assert rows(got, "category_name", "item_id") == [("two\nlines", 3)]


def test_missing_columns(spark, landing):
    path = landing.path("a", "price_log")
    put(path, "datetime,item_id\n2024-01-01,1\n")
    with pytest.raises(ValueError, match="price"):
        read_increment_csv(spark, landing, "price_log", ["a"])
    with pytest.raises(AnalysisException):
        read_full_csv(spark, path, "customer_research")


def test_nan_to_null_leaves_other_columns(spark):
    df = spark.createDataFrame([("nan", "nan", 1)], "a string, b string, c int")
    assert rows(nan_to_null(df, ["a"])) == [(None, "nan", 1)]
    assert rows(nan_to_null(df)) == [(None, None, 1)]


@pytest.mark.parametrize("text, column, value", [
    ("5", "item_id", 5), (" -7 ", "item_id", -7), ("5.0", "item_id", 5), ("0.4999999", "item_id", 0), ("1e3", "item_id", 1000),
    ("2147483648", "item_id", None), ("2147483648.0", "item_id", None), ("five", "item_id", None), ("1.2.3", "item_id", None),
    (".5", "price", Decimal("0.50")), ("5.", "price", Decimal("5.00")), ("1e-1", "price", Decimal("0.10")),
    ("123456789.00", "price", None), ("inf", "price", None), ("9,5", "price", None),
    ("2024-1-5", "datetime", dt.datetime(2024, 1, 5)), ("2024-01-05T06:07:08.9", "datetime", dt.datetime(2024, 1, 5, 6, 7, 8, 900000)),
    ("20240105", "datetime", dt.datetime(2024, 1, 5)), ("20241305", "datetime", None), ("2024-02-30", "datetime", None),
    ("2024", "datetime", None), ("yesterday", "datetime", None),
])
def test_conversions(spark, text, column, value):
    df = spark.createDataFrame([(text,)], f"{column} string")
    got = infer_and_cast(df, TABLES["staging.price_log"].schema, on_error="flag").first()
    assert (got[column], got[REJECTED]) == (value, [] if value is not None else [column])


def test_unknown_error_mode(spark):
    with pytest.raises(ValueError):
        infer_and_cast(spark.range(1), TABLES["staging.price_log"].schema, on_error="ignore")


def test_files_available(spark, landing):
    put(landing.path("2024-01-01", "price_log"), "x\n1\n")
    put(landing.path("2024-01-02", "price_log"), "")
    expected = expected_increments(spark, ["2024-01-01", "2024-01-02", "2024-01-03"], ["price_log"])
    assert rows(files_available(expected, landing)) == [
        ("2024-01-01", "price_log", 0), ("2024-01-02", "price_log", 1), ("2024-01-03", "price_log", 1)]


def test_increments_available_looks_at_its_own_paths(spark, landing):
    put(landing.path("2024-01-01", "price_log"), "x\n1\n")
    put(f"{landing.root}/2024-01-02/price_log_inc.csv/part-0.csv", "x\n1\n")
    got = increments_available(spark, landing, ["2024-01-01", "2024-01-02", "2024-01-03"], ["price_log"])
    assert rows(got, "increment", "check_result") == [("2024-01-01", 0), ("2024-01-02", 0), ("2024-01-03", 1)]
    none = increments_available(spark, landing, ["2024-01-04"], ["price_log", "user_order_log"])
    assert rows(none, "check_result") == [(1,), (1,)]


def test_files_available_without_landing_folder(spark):
    expected = expected_increments(spark, ["2024-01-01"], ["price_log"])
    assert rows(files_available(expected, Landing("/tmp/does-not-exist-here"))) == [("2024-01-01", "price_log", 1)]


def test_quoted_line_breaks_in_split_files(spark, tmp_path):
    """Records are found whatever the byte ranges that the tasks read."""
    path = str(tmp_path / "breaks.csv")
    fields = [(str(i), ["plain", f"two\nlines {i}", 'say ""hi""\nthen\n\n""bye""', "a,b\r\nc", "", "x" * 300 + "\n" + "y" * 300][i % 6])
              for i in range(400)]
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("k,v\r\n" + "".join(f'{k},"{v}"\r\n' if v else f"{k},\r\n" for k, v in fields) + "\n")
    want = sorted((k, v.replace('""', '"') or None) for k, v in fields)
    for size in ("128m", "4k", "700b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            df = read_csv_by_name(spark, path, multiline=True)
            tasks = spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions()
            got = sorted((r.k, r.v) for r in df.collect())
            order = [r.k for r in df.orderBy("_position").collect()]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == want and order == [k for k, _ in fields]
        assert tasks > 8


def test_quoted_line_breaks_keep_the_guards(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "a.csv").write_text('k,v\n1,"a\nb",surplus\n2\n')
    rows_ = read_csv_by_name(spark, str(folder), multiline=True).orderBy("k").collect()
    assert [(r.k, r.v) for r in rows_] == [("1", "a\nb"), ("2", None)]
    assert rows_[0]["_corrupt_record"] is not None and rows_[1]["_corrupt_record"] is None
    (folder / "b.csv").write_text('v,k\n1,2\n')
    with pytest.raises(Exception, match="header differs"):
        read_csv_by_name(spark, str(folder), multiline=True).collect()


def test_quoted_line_breaks_shuffle_no_records(spark, tmp_path):
    """Lines stay with the task that reads them, but for those of records across byte ranges."""
    path = str(tmp_path / "breaks.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("k,v\n" + "".join(f'{i},"a\n{i}"\n' for i in range(2000)) + '"x' + "\n" * 3000 + '",y\n9,"z\n"\n')
    for size in ("128m", "3k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            df = read_csv_by_name(spark, path, multiline=True)
            got = [(r.k, r.v) for r in df.orderBy("_position").collect()]
            shuffled = df.select("k", "v")
            shuffled.collect()
            metrics = shuffled._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == [*((str(i), f"a\n{i}") for i in range(2000)), ("x" + "\n" * 3000, "y"), ("9", "z\n")]
        assert "MapInArrow" in metrics and "SortMergeJoin" not in metrics
