import datetime as dt
import os
import time
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from martloom.operators import constraints
from martloom.operators.quality import QualityError
from martloom.plans import runs
from martloom.plans.catalog import loads
from martloom.plans.enforce import enforced, overwrite_enforced, read_quarantined
from martloom.schemas import TABLES
from martloom.session import scratch_path
from martloom.sources import files
from martloom.sources.csv_files import read_full_csv
from martloom.sources.landing import Landing
from martloom.sources.warehouse import Warehouse
from tests.conftest import rows

D = dt.date
ORDER_HEAD = ("id,uniq_id,date_time,city_id,city_name,customer_id,first_name,last_name,item_id,item_name,"
              "quantity,payment_amount")


def put(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def order(uid, stamp, customer=1, item=7, qty=1, pay="10.00", status=None, city=1):
    line = f"0,{uid},{stamp},{city},City {city},{customer},Ann,Lee {customer},{item},item {item},{qty},{pay}"
    return line if status is None else f"{line},{status}"


def land(landing, day, orders, status_column=True, research="20240101"):
    put(landing.path(day, "user_order_log"), ORDER_HEAD + (",status" if status_column else ""), *orders)
    put(landing.path(day, "user_activity_log"), "uniq_id,date_time,action_id,customer_id,quantity,action",
        f"{day},{day} 09:00:00,1,1,3,view", f"{day},{day} 10:00:00,2,1,5,view")
    put(landing.path(day, "customer_research"), "date_id,category_id,geo_id,sales_qty,sales_amt", f"{research},4,1,2,9.50")
    put(landing.path(day, "price_log"), "datetime,category_id,category_name,item_id,price", f"{day} 00:00:00,4,toys,7,10.00")


@pytest.fixture
def landing(spark):
    landing = Landing(scratch_path(spark, "landing"))
    # old files have no status column
    land(landing, "2024-01-03", [order("a", "2024-01-03 10:00:00"), order("a", "2024-01-03 11:00:00", pay="99.00"),
                                 order("b", "2024-01-03 12:00:00", customer=2)], status_column=False)
    land(landing, "2024-01-10", [order("c", "2024-01-10 10:00:00", status="shipped", item=8),
                                 order("d", "2024-01-03 10:00:00", status="refunded", pay="4.00"),  # late
                                 order("e", "2024-01-10 11:00:00", status="", customer=3, city=2)])
    return landing


def snapshot(wh, skip=()):
    names = ["staging.load_manifest", "mart.f_daily_sales_signed", "staging.user_order_log", "staging.user_activity_log", "staging.price_log", "staging.customer_research",
             "mart.d_calendar", "mart.d_customer", "mart.d_item", "mart.d_city", "mart.f_sales", "mart.f_customer_retention"]
    return {n: rows(wh.read(n).drop("id") if n.startswith("staging") else wh.read(n)) for n in names if n not in skip}


def test_daily_runs(spark, landing):
    root = scratch_path(spark, "wh")
    runs.run_increment(spark, landing, root, "2024-01-03", batch_id=1)
    wh = runs.run_increment(spark, landing, root, "2024-01-10", batch_id=2)

    staged = wh.read("staging.user_order_log")
    assert rows(staged, "uniq_id", "payment_amount", "status") == sorted([
        ("a", Dec("10.00"), "shipped"), ("b", Dec("10.00"), "shipped"), ("c", Dec("10.00"), "shipped"),
        ("d", Dec("4.00"), "refunded"), ("e", Dec("10.00"), None)], key=repr)
    assert rows(wh.read("staging.user_activity_log"), "uniq_id", "quantity") == [("2024-01-03", 3), ("2024-01-10", 3)]
    assert rows(wh.read("mart.d_customer"), "id", "customer_id") == [(1, 1), (2, 2), (3, 3)]
    assert rows(wh.read("mart.d_city"), "id", "city_id", "city_name") == [(1, 1, "City 1"), (2, 2, "City 2")]
    assert rows(wh.read("mart.d_item"), "item_id", "category_id") == [(7, 0), (8, 0)]
    assert rows(wh.read("mart.d_calendar"), "date_id") == [(20240101,), (20240103,), (20240110,)]
    # the late refund of the 3rd is not part of the run of the 10th
    assert rows(wh.read("mart.f_sales"), "date_id", "payment_amount") == [
        (20240103, Dec("10.00")), (20240103, Dec("10.00")), (20240110, Dec("10.00"))]
    retention = wh.read("mart.f_customer_retention").where("week_start = date'2024-01-01'")
    assert rows(retention, "new_customers_count", "returning_customers_count", "period_id", "item_id",
                "returning_customers_revenue", "customers_refunded") == [(1, 1, 2, 7, Dec("14.00"), 1)]
    history = rows(wh.read("mart.load_history"), "batch_id", "target_table")
    assert len(history) == 24 and len(set(history)) == 24
    checks = wh.read("dq_checks_results")
    assert checks.count() == 12 and checks.where("check_result <> 0").count() == 0


def test_repeated_run_changes_nothing(spark, landing):
    root = scratch_path(spark, "wh")
    wh = runs.run_increment(spark, landing, root, "2024-01-10")
    before = snapshot(wh)
    runs.run_increment(spark, landing, root, "2024-01-10")
    assert snapshot(wh) == before


def test_backfill_repairs_late_rows(spark, landing):
    land(landing, "2024-01-04", [order("f", "2024-01-04 10:00:00", status="shipped")])
    daily, once = scratch_path(spark, "wh"), scratch_path(spark, "wh")
    for day in ("2024-01-03", "2024-01-04"):
        runs.run_increment(spark, landing, daily, day)
    wh = runs.run_backfill(spark, landing, once, "2024-01-03", "2024-01-04", batch_id=5)
    skip = ["mart.f_customer_retention"]  # the daily run writes the week before, the back-fill the touched week
    assert snapshot(wh, skip) == snapshot(Warehouse(spark, daily), skip)
    assert rows(wh.read("mart.f_customer_retention"), "week_start", "new_customers_count", "returning_customers_count") == [
        (D(2024, 1, 1), 1, 1)]

    runs.run_backfill(spark, landing, once, "2024-01-10", "2024-01-10")
    assert rows(wh.read("mart.f_sales").where("date_id = 20240103"), "payment_amount") == [
        (Dec("-4.00"),), (Dec("10.00"),), (Dec("10.00"),)]
    before = snapshot(wh)
    runs.run_backfill(spark, landing, once, "2024-01-10", "2024-01-10")
    assert snapshot(wh) == before

    # a corrected file no longer has the late row: its date is written again without it
    land(landing, "2024-01-10", [order("c", "2024-01-10 10:00:00", status="shipped", item=8)])
    runs.run_backfill(spark, landing, once, "2024-01-10", "2024-01-10")
    assert rows(wh.read("mart.f_sales").where("date_id = 20240103"), "payment_amount") == [(Dec("10.00"),)] * 2


def test_missing_file_stops_before_loading(spark, landing):
    root = scratch_path(spark, "wh")
    with pytest.raises(QualityError, match="all_files.file_sensor"):
        runs.run_increment(spark, landing, root, "2024-01-05")
    wh = Warehouse(spark, root)
    assert rows(wh.read("dq_checks_results")) == [("all_files", "file_sensor", D(2024, 1, 5), 1)]
    assert wh.read("staging.user_order_log").count() == 0


def test_bad_rows_stop_after_staging(spark, landing):
    land(landing, "2024-01-11", [order("z", "2024-01-11 10:00:00", customer="", status="test")])
    root = scratch_path(spark, "wh")
    with pytest.raises(QualityError, match="check_customer_id.*check_test_data"):
        runs.run_increment(spark, landing, root, "2024-01-11")
    wh = Warehouse(spark, root)
    assert wh.read("staging.user_order_log").count() == 1
    assert wh.read("mart.f_sales").count() == 0
    # bad rows already staged fail the whole-table check of later days, not one limited to their own increment
    with pytest.raises(QualityError):
        runs.run_increment(spark, landing, root, "2024-01-10")
    runs.run_increment(spark, landing, root, "2024-01-10", whole_table_checks=False)
    assert wh.read("mart.f_sales").count() == 1


def test_bad_rows_can_be_set_aside(spark, landing):
    land(landing, "2024-01-11", [order("y", "2024-01-11 10:00:00", status="shipped"),
                                 order("z", "2024-01-11 10:00:00", customer="", status="test")])
    root = scratch_path(spark, "wh")
    for _ in range(2):
        wh = runs.run_increment(spark, landing, root, "2024-01-11", bad_rows="quarantine")
        assert rows(wh.read("staging.user_order_log"), "uniq_id") == [("y",)]
        assert rows(runs.read_quarantine(wh, "user_order_log"), "uniq_id", "broken_checks") == [
            ("z", ["check_customer_id:customer_id", "check_test_data:status"])]
        assert wh.read("mart.f_sales").count() == 1
    failed = wh.read("dq_checks_results").where("check_result = 1")
    assert rows(failed.distinct(), "table_name", "check_name") == [
        ("user_order_log", "check_customer_id"), ("user_order_log", "check_test_data")]
    # a corrected file empties the quarantine of its date
    land(landing, "2024-01-11", [order("z", "2024-01-11 10:00:00", status="shipped")])
    runs.run_increment(spark, landing, root, "2024-01-11", bad_rows="quarantine")
    assert runs.read_quarantine(wh, "user_order_log").count() == 0
    with pytest.raises(ValueError):
        runs.run_increment(spark, landing, root, "2024-01-11", bad_rows="ignore")


def daily_sales(wh):
    return rows(wh.read("mart.f_daily_sales_signed"), "date_id", "item_id", "customer_id", "status", "quantity", "payment_amount", "price")


def test_signed_daily_sales_merge_late_rows(spark, landing):
    root = scratch_path(spark, "wh")
    runs.run_increment(spark, landing, root, "2024-01-03")
    wh = runs.run_increment(spark, landing, root, "2024-01-10")
    want = [(20240103, 7, 1, "refunded", -1, Dec("-4.00"), Dec("4.00")), (20240103, 7, 1, "shipped", 1, Dec("10.00"), Dec("10.00")),
            (20240103, 7, 2, "shipped", 1, Dec("10.00"), Dec("10.00")), (20240110, 8, 1, "shipped", 1, Dec("10.00"), Dec("10.00"))]
    assert daily_sales(wh) == want
    runs.run_increment(spark, landing, root, "2024-01-10")
    assert daily_sales(wh) == want
    land(landing, "2024-01-04", [order("f", "2024-01-03 09:00:00", status="shipped", pay="1.50", qty=2)])
    runs.run_increment(spark, landing, root, "2024-01-04")
    assert (20240103, 7, 1, "shipped", 3, Dec("11.50"), Dec("3.83")) in daily_sales(wh)
    # a corrected file without the late row takes its part back
    land(landing, "2024-01-10", [order("c", "2024-01-10 10:00:00", status="shipped", item=8)])
    runs.run_increment(spark, landing, root, "2024-01-10")
    assert not [r for r in daily_sales(wh) if r[3] == "refunded"]


def test_constraints_stop_a_run(spark, landing):
    twice = [order("g", "2024-01-11 10:00:00", status="shipped"),
             order("h", "2024-01-11 11:00:00", status="shipped").replace("item 7", "item seven")]
    land(landing, "2024-01-11", twice)
    root = scratch_path(spark, "wh")
    with pytest.raises(QualityError, match="primary_key:item_id"):
        runs.run_increment(spark, landing, root, "2024-01-11")
    wh = Warehouse(spark, root)
    assert wh.read("mart.d_item").count() == 0 and wh.read("mart.f_sales").count() == 0
    assert ("mart.d_item", "primary_key:item_id", D(2024, 1, 11), 1) in rows(wh.read("dq_checks_results"))
    # an item that is known already is no new row, whatever its name
    land(landing, "2024-01-11", twice[:1])
    runs.run_increment(spark, landing, root, "2024-01-11")
    land(landing, "2024-01-12", [twice[1].replace("2024-01-11", "2024-01-12")])
    runs.run_increment(spark, landing, root, "2024-01-12")
    assert rows(wh.read("mart.d_item"), "item_id", "item_name") == [(7, "item 7")]
    # names that are too long for the dimension
    land(landing, "2024-01-13", [order("i", "2024-01-13 10:00:00", status="shipped", item=9).replace("item 9", "x" * 60)])
    with pytest.raises(QualityError, match="varchar:item_name"):
        runs.run_increment(spark, landing, root, "2024-01-13")


def test_constraint_breakers_are_set_aside_with_what_refers_to_them(spark, landing):
    land(landing, "2024-01-11", [order("g", "2024-01-11 10:00:00", status="shipped"),
                                 order("h", "2024-01-11 11:00:00", status="shipped").replace("item 7", "item seven"),
                                 order("i", "2024-01-11 12:00:00", status="shipped", item=8)])
    root = scratch_path(spark, "wh")
    for _ in range(2):
        wh = runs.run_increment(spark, landing, root, "2024-01-11", bad_rows="quarantine")
        assert rows(wh.read("mart.d_item"), "item_id") == [(8,)]
        assert rows(read_quarantined(wh, "mart.d_item"), "item_name", "broken_constraints") == [
            ("item 7", ["primary_key:item_id"]), ("item seven", ["primary_key:item_id"])]
        # the sales of that item have no parent
        assert rows(wh.read("mart.f_sales"), "item_id") == [(8,)]
        assert rows(read_quarantined(wh, "mart.f_sales"), "item_id", "broken_constraints") == [
            (7, ["foreign_key:item_id"])] * 2
    with pytest.raises(QualityError, match="foreign_key:item_id"):
        enforced(wh, "mart.f_sales", wh.read("mart.f_sales").withColumn("item_id", F.lit(99)), D(2024, 1, 11))
    with pytest.raises(QualityError, match="primary_key:item_id"):
        enforced(wh, "mart.d_item", wh.read("mart.d_item").drop("id"), D(2024, 1, 11))


def test_index_is_built_again_after_a_crash(spark, landing):
    root = scratch_path(spark, "wh")
    wh = runs.run_increment(spark, landing, root, "2024-01-03")
    # keys that a run did not come to add, and a warehouse that is older than its index and manifest
    wh.keys("mart.d_item").replace(wh.read("mart.d_item").limit(0))
    assert wh.indexed_keys("mart.d_item").read().count() == 1
    files.delete(spark, wh.path("staging.load_manifest"))
    runs.run_increment(spark, landing, root, "2024-01-10")
    assert wh.read("mart.f_customer_retention").where("week_start = date'2024-01-01'").count() == 1


def test_full_rebuild(spark):
    source, root = scratch_path(spark, "source"), scratch_path(spark, "wh")
    put(f"{source}/user_order_log.csv", ORDER_HEAD,
        order("a", "2024-01-03 10:00:00", qty=2), order("a", "2024-01-03 11:00:00", qty=1, pay="5.00"),
        order("b", "2024-01-04 12:00:00", customer=2, qty=0))
    put(f"{source}/user_activity_log.csv", "date_time,action_id,customer_id,quantity", "2024-01-05 09:00:00,1,1,3",
        "2024-01-05 19:00:00,1,1,4")
    put(f"{source}/customer_research.csv", "date_id,category_id,geo_id,sales_qty,sales_amt", "20240101,4,1,2,9.50",
        "20240101,4,1,3,0.50")
    for batch in (1, 2):
        wh = runs.run_full(spark, source, root, "2024-01-31", batch_id=batch)
        # nothing is deduplicated here
        assert wh.read("staging.user_order_log").count() == 3
        assert rows(wh.read("mart.f_daily_sales")) == [
            (20240103, 7, 1, Dec("5.00"), 3, Dec("15.00")), (20240104, 7, 2, None, 0, Dec("10.00"))]
        assert rows(wh.read("mart.f_activity")) == [(1, 20240105, 7)]
        assert rows(wh.read("mart.f_research")) == [(20240101, 4, 1, 0, 0, 5, Dec("10.00"))]
        assert rows(wh.read("mart.d_category")) == [(1, 4, "category_4")]
        assert rows(wh.read("mart.d_calendar"), "date_id") == [(20240101,), (20240103,), (20240104,), (20240105,)]
        assert rows(wh.read("mart.d_customer")) == [(1, 1, "Ann", "Lee 1", 1), (2, 2, "Ann", "Lee 2", 1)]
    assert wh.read("mart.load_history").count() == 22
    counted = {r.target_table: r.row_count for r in wh.read("mart.load_history").where("batch_id = 2").collect()}
    assert counted["staging.user_order_log"] == 3 and counted["mart.f_daily_sales"] == 2 and counted["mart.d_category"] == 1


def test_rebuilt_tables_satisfy_their_constraints(spark):
    source, root = scratch_path(spark, "source"), scratch_path(spark, "wh")
    put(f"{source}/user_order_log.csv", ORDER_HEAD, order("a", "2024-01-03 10:00:00"), order("b", "2024-01-04 12:00:00", customer=2))
    put(f"{source}/user_activity_log.csv", "date_time,action_id,customer_id,quantity", "2024-01-05 09:00:00,1,1,3")
    put(f"{source}/customer_research.csv", "date_id,category_id,geo_id,sales_qty,sales_amt", "20240101,4,1,2,9.50")
    wh = runs.run_full(spark, source, root, "2024-01-31")
    for name in runs.REBUILT:
        spec = TABLES[name]
        table = wh.read(name)
        assert constraints.check_primary_key(table, spec.primary_key).count() == 0, name
        assert constraints.check_table(table, spec).where(F.col("bad_rows") > 0).count() == 0, name
        for fk in spec.foreign_keys:
            orphans = constraints.check_foreign_key(table, fk.column, wh.read(fk.parent), fk.parent_column, fk.unknown_keys)
            assert orphans.count() == 0, (name, fk)


def full_extracts(spark):
    source = scratch_path(spark, "source")
    put(f"{source}/user_order_log.csv", ORDER_HEAD, order("a", "2024-01-03 10:00:00"), order("b", "2024-01-03 11:00:00", customer=2))
    put(f"{source}/user_activity_log.csv", "uniq_id,date_time,action_id,customer_id,quantity,action", "a,2024-01-03 09:00:00,1,1,3,view")
    put(f"{source}/customer_research.csv", "date_id,category_id,geo_id,sales_qty,sales_amt", "2024-01-03 00:00:00,4,1,2,9.50")
    return source


def test_rebuilt_facts_are_computed_once(spark, monkeypatch):
    """Constraints of a fact are checked on what is written, not on the rows computed once more."""
    seen, daily = spark.sparkContext.accumulator(0), runs.facts.f_daily_sales

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def computed(orders):
        sales = daily(orders)
        return sales.mapInArrow(counted, sales.schema)

    monkeypatch.setattr(runs.facts, "f_daily_sales", computed)
    wh = runs.run_full(spark, full_extracts(spark), scratch_path(spark, "wh"), "2024-01-31", batch_id=4)
    assert rows(wh.read("mart.f_daily_sales"), "customer_id", "payment_amount") == [(1, Dec("10.00")), (2, Dec("10.00"))]
    assert seen.value == 2
    loads = wh.read("mart.load_history").where("target_table = 'mart.f_daily_sales'")
    assert rows(loads, "batch_id", "row_count") == [(4, 2)]
    assert not [n for n in os.listdir(f"{wh.root}/mart") if "_next" in n]


@pytest.mark.parametrize("bad, constraint", [
    ((20240103, 7, 1, Dec("5.00"), 1, Dec("5.00")), "primary_key:date_id,item_id,customer_id"),
    ((20240103, 7, None, Dec("5.00"), 1, Dec("5.00")), "primary_key:date_id,item_id,customer_id"),
    ((20240103, 8, 1, Dec("5.00"), 1, Dec("5.00")), "foreign_key:item_id"),
    ((20240103, 7, 2, Dec("5.00"), 1, Dec("123456789.00")), "decimal:payment_amount"),
])
def test_facts_that_break_a_constraint_are_not_written(spark, bad, constraint):
    wh = runs.run_full(spark, full_extracts(spark), scratch_path(spark, "wh"), "2024-01-31")
    before = rows(wh.read("mart.f_daily_sales"))
    schema = "date_id int, item_id int, customer_id bigint, price decimal(24,2), quantity bigint, payment_amount decimal(24,2)"
    new = spark.createDataFrame([(20240103, 7, 1, Dec("6.00"), 1, Dec("6.00")), bad], schema)
    with pytest.raises(QualityError, match=constraint):
        overwrite_enforced(wh, "mart.f_daily_sales", new, D(2024, 1, 31), batch_id=5)
    assert rows(wh.read("mart.f_daily_sales")) == before
    overwrite_enforced(wh, "mart.f_daily_sales", new, D(2024, 1, 31), "quarantine", batch_id=5)
    aside = read_quarantined(wh, "mart.f_daily_sales").where(F.array_contains("broken_constraints", constraint))
    assert aside.count() + wh.read("mart.f_daily_sales").count() == 2
    assert aside.count() == (2 if bad[:3] == (20240103, 7, 1) else 1)
    assert not [n for n in os.listdir(f"{wh.root}/mart") if "_next" in n]


def test_sales_are_computed_once(spark, landing, monkeypatch):
    """As the facts of a rebuild: their constraints are checked on what is written, in daily runs and back-fills."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def counting(operator):
        def computed(*args):
            sales = operator(*args)
            return sales.mapInArrow(counted, sales.schema)
        return computed

    for name in ("f_sales", "f_sales_backfill"):
        monkeypatch.setattr(runs.facts, name, counting(getattr(runs.facts, name)))
    root = scratch_path(spark, "wh")
    runs.run_increment(spark, landing, root, "2024-01-03", batch_id=1)
    assert seen.value == 2
    land(landing, "2024-01-04", [order("f", "2024-01-04 10:00:00", status="shipped")])
    wh = runs.run_backfill(spark, landing, root, "2024-01-04", "2024-01-04", batch_id=2)
    assert seen.value == 3 and wh.read("mart.f_sales").count() == 3
    loads = wh.read("mart.load_history").where("target_table = 'mart.f_sales'")
    assert rows(loads, "batch_id", "row_count") == [(1, 2), (2, 1)]


def test_extracts_may_go_once_they_are_staged(spark):
    """Nothing of a rebuild reads the extracts after its staging."""
    source, root, there = full_extracts(spark), scratch_path(spark, "wh"), []

    def staged():
        there.append(Warehouse(spark, root).read("staging.user_order_log").count())
        files.delete(spark, source)

    wh = runs.run_full(spark, source, root, "2024-01-31", staged=staged)
    assert there == [2] and not files.exists(spark, source)
    assert [wh.read(f"mart.{name}").count() for name in ("f_daily_sales", "f_activity", "f_research", "d_customer")] == [2, 1, 1, 2]


def test_query_extracts_are_compressed(spark):
    path = scratch_path(spark, "packed") + "/customer_research.csv"
    table = spark.sql("select timestamp_ntz'2024-01-03 10:00:00' + make_interval(0, 0, 0, int(id)) as date_id, int(id) as category_id, 1 as geo_id, "
                     "2 as sales_qty, cast(9.5 as decimal(14,2)) as sales_amt from range(0, 3000, 1, 3)")
    loads._write_csv(table, path, compression="gzip")
    assert all(name.endswith(".csv.gz") for name in files.names(spark, path))
    back = read_full_csv(spark, path, "customer_research").select(*table.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, table.collect()))


def test_shuffles_end_with_their_load(spark):
    """A table's load leaves no shuffle files behind, and the setting as it was."""
    key, disk = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {n for n in (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size())) if n.startswith("shuffle_")}
    wh, before = Warehouse(spark, scratch_path(spark, "wh")), spark.conf.get(key)
    wh.create_tables(["mart.f_activity"])
    there = shuffles()
    table = spark.range(0, 1000, 1, 3).groupBy((F.col("id") % 7).alias("activity_id")).agg(F.count("*").alias("click_number"))
    wh.overwrite("mart.f_activity", table.select("activity_id", F.lit(20240103).alias("date_id"), "click_number"))
    until = time.time() + 20
    while (left := shuffles() - there) and time.time() < until:
        time.sleep(0.2)
    assert not left and spark.conf.get(key) == before and wh.read("mart.f_activity").count() == 7
