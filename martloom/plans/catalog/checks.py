"""Quality gates and constraint checks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import timestamp_to_date
from martloom.operators import constraints, quality
from martloom.operators.dimensions import d_customer_new
from martloom.plans import inputs
from martloom.plans.catalog.columns import HISTORY_END
from martloom.plans.catalog.marts import history
from martloom.plans.catalog.registry import query
from martloom.session import scratch_path
from martloom.sources.landing import Landing, files_available
from martloom.sources.warehouse import Warehouse

CHECK_DATE = "2024-01-31"
_DATE_SQL = f"date '{CHECK_DATE}' check_date"


def _result_sql(table: str, check: str, source: str, bad: str) -> str:
    return (f"select '{table}' table_name, '{check}' check_name, {_DATE_SQL}, "
            f"cast(case when count(*) > 0 then 1 else 0 end as int) check_result from {source} where {bad}")


_TEST = "lower(coalesce({0}, '')) like '%test%'"
_ORDER_CUSTOMER = _result_sql("user_order_log", "check_customer_id", "uol_dirty", "customer_id is null")
_ORDER_STATUS = _result_sql("user_order_log", "check_test_data", "uol_dirty", _TEST.format("status"))
_ORDER_ITEM = _result_sql("user_order_log", "check_test_item", "uol_dirty", _TEST.format("item_name"))
_ACTIVITY_CUSTOMER = _result_sql("user_activity_log", "check_customer_id", "ual", "customer_id is null")
_ACTIVITY_ACTION = _result_sql("user_activity_log", "check_test_data", "ual", _TEST.format("action"))


def _dirty(spark, sf, *columns):
    return inputs.order_log(spark, sf, *columns, dirty=True)


@query("dq_files_available", """select strftime(d, '%Y-%m-%d') increment, 'user_activity_log' dataset,
  cast(case when d in (select cast(date_time as date) from ual) then 0 else 1 end as int) check_result
  from (select cast(o_orderdate as date) d from orders union select cast(date_time as date) from ual)""", ("ual",))
def _(spark, sf):
    landing = Landing(scratch_path(spark, "landing"), "{root}/{dataset}/increment={increment}")
    rows = inputs.activity_log(spark, sf).withColumn("increment", F.date_format("date_time", "yyyy-MM-dd"))
    rows.write.partitionBy("increment").option("header", True).csv(f"{landing.root}/user_activity_log")
    dates = inputs.table(spark, sf, "orders").select(timestamp_to_date("o_orderdate").alias("d")).union(
        rows.select(timestamp_to_date("date_time"))).distinct()
    expected = dates.select(
        F.date_format("d", "yyyy-MM-dd").alias("increment"), F.lit("user_activity_log").alias("dataset"))
    return files_available(expected, landing)


@query("dq_orders_customer_null", _ORDER_CUSTOMER, ("uol_dirty",))
def _(spark, sf):
    return quality.check_rules(_dirty(spark, sf, "customer_id"), [quality.ORDERS_CUSTOMER_NULL], CHECK_DATE)


@query("dq_activity_customer_null", _ACTIVITY_CUSTOMER, ("ual",))
def _(spark, sf):
    return quality.check_rules(inputs.activity_log(spark, sf), [quality.ACTIVITY_CUSTOMER_NULL], CHECK_DATE)


@query("dq_orders_test_status", _ORDER_STATUS, ("uol_dirty",))
def _(spark, sf):
    return quality.check_rules(_dirty(spark, sf, "status"), [quality.ORDERS_TEST_STATUS], CHECK_DATE)


@query("dq_activity_test_action", _ACTIVITY_ACTION, ("ual",))
def _(spark, sf):
    return quality.check_rules(inputs.activity_log(spark, sf), [quality.ACTIVITY_TEST_ACTION], CHECK_DATE)


@query("dq_orders_test_item", _ORDER_ITEM, ("uol_dirty",))
def _(spark, sf):
    return quality.check_rules(_dirty(spark, sf, "item_name"), [quality.ORDERS_TEST_ITEM], CHECK_DATE)


@query("dq_rule_counts", """select 'user_order_log' table_name, 'check_customer_id' check_name,
  count(*) bad_rows from uol_dirty where customer_id is null
  union all select 'user_order_log', 'check_test_data', count(*) from uol_dirty where lower(status) like '%test%'
  union all select 'user_order_log', 'check_test_item', count(*) from uol_dirty
    where lower(item_name) like '%test%'""", ("uol_dirty",))
def dq_rule_counts(spark, sf):
    return quality.violations(_dirty(spark, sf, "customer_id", "status", "item_name"), quality.ORDER_RULES)


def _logged(spark, sf):
    """Gate both logs the way a run does; the results are in the results table whatever the outcome."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    wh.create_tables(["dq_checks_results"])
    outcome = {}
    for rows, rules in (
        (_dirty(spark, sf, "customer_id", "status", "item_name"), quality.ORDER_RULES),
        (inputs.activity_log(spark, sf), quality.ACTIVITY_RULES),
    ):
        try:
            quality.gate(quality.check_rules(rows, rules, CHECK_DATE), wh.log_checks)
            outcome[rules[0].table_name] = "passed"
        except quality.QualityError:
            outcome[rules[0].table_name] = "failed"
    return wh.read("dq_checks_results"), outcome


@query("dq_results_sink", " union all ".join(
    [_ORDER_CUSTOMER, _ORDER_STATUS, _ORDER_ITEM, _ACTIVITY_CUSTOMER, _ACTIVITY_ACTION]), ("uol_dirty", "ual"))
def _(spark, sf):
    return _logged(spark, sf)[0]


@query("dq_gate", f"""select table_name, case when max(check_result) = 1 then 'failed' else 'passed' end outcome,
  cast(sum(check_result) as bigint) failed_checks from ({" union all ".join(
    [_ORDER_CUSTOMER, _ORDER_STATUS, _ORDER_ITEM, _ACTIVITY_CUSTOMER, _ACTIVITY_ACTION])}) group by table_name""",
       ("uol_dirty", "ual"))
def _(spark, sf):
    results, outcome = _logged(spark, sf)
    word = F.create_map(*[F.lit(x) for pair in outcome.items() for x in pair])
    return results.groupBy("table_name").agg(F.sum("check_result").alias("failed_checks")).select(
        "table_name", word[F.col("table_name")].alias("outcome"), "failed_checks")


@query("dq_block_rows", f"""select uniq_id, customer_id, item_name, status from uol_dirty
  where customer_id is not null and not {_TEST.format('status')} and not {_TEST.format('item_name')}""",
       ("uol_dirty",))
def _(spark, sf):
    accepted, _blocked = quality.block_rows(
        _dirty(spark, sf, "uniq_id", "customer_id", "item_name", "status"), quality.ORDER_RULES)
    return accepted


@query("dq_blocked_rows", f"""select uniq_id, customer_id, item_name, status,
  concat_ws(',', case when customer_id is null then 'check_customer_id:customer_id' end,
    case when {_TEST.format('status')} then 'check_test_data:status' end,
    case when {_TEST.format('item_name')} then 'check_test_item:item_name' end) broken_checks from uol_dirty
  where customer_id is null or {_TEST.format('status')} or {_TEST.format('item_name')}""", ("uol_dirty",))
def _(spark, sf):
    _accepted, blocked = quality.block_rows(
        _dirty(spark, sf, "uniq_id", "customer_id", "item_name", "status"), quality.ORDER_RULES)
    return blocked.withColumn("broken_checks", F.concat_ws(",", "broken_checks"))


# declared constraints

@query("check_primary_key", f"""select customer_id, count(*) row_count from
  (select customer_id, first_name, last_name from uol_dirty where customer_id not in
    (select customer_id from uol where date_time < timestamp '{HISTORY_END}')
   group by customer_id, first_name, last_name)
  group by customer_id having count(*) > 1 or customer_id is null""", ("uol", "uol_dirty"))
def _(spark, sf):
    # customers seen under two names come out of the incremental load twice
    new = d_customer_new(
        _dirty(spark, sf, "customer_id", "first_name", "last_name", "city_id"), history(spark, sf, "customer_id"))
    return constraints.check_primary_key(new, ["customer_id"])


@query("check_not_null", """select 'not_null' constraint_name, 'date_time' column_name,
  count(case when date_time is null then 1 end) bad_rows from uol_dirty
  union all select 'not_null', 'customer_id', count(case when customer_id is null then 1 end) from uol_dirty
  union all select 'not_null', 'status', count(case when status is null then 1 end) from uol_dirty""",
       ("uol_dirty",))
def _(spark, sf):
    return constraints.check_not_null(
        _dirty(spark, sf, "date_time", "customer_id", "status"), ["date_time", "customer_id", "status"])


@query("check_foreign_key", f"""select distinct item_id from uol where item_id not in
  (select item_id from uol where date_time < timestamp '{HISTORY_END}') and item_id <> 0""", ("uol",))
def _(spark, sf):
    return constraints.check_foreign_key(
        inputs.order_log(spark, sf, "item_id"), "item_id", history(spark, sf, "item_id"), "item_id", (0,))


@query("check_varchar_length", """select 'varchar' constraint_name, 'last_name' column_name,
  count(case when length(last_name) > 15 then 1 end) bad_rows from uol_dirty
  union all select 'varchar', 'item_name', count(case when length(item_name) > 15 then 1 end) from uol_dirty""",
       ("uol_dirty",))
def _(spark, sf):
    return constraints.check_varchar_length(
        _dirty(spark, sf, "last_name", "item_name"), {"last_name": 15, "item_name": 15})


@query("check_decimal_range", """select 'decimal' constraint_name, 'payment_amount' column_name,
  count(case when payment_amount > 9999.99 then 1 end) bad_rows from uol
  union all select 'decimal', 'total', count(case when payment_amount > 99999999.99 then 1 end) from uol""", ("uol",))
def _(spark, sf):
    rows = inputs.order_log(spark, sf, "payment_amount").withColumn("total", F.col("payment_amount"))
    return constraints.check_decimal_range(
        rows, {"payment_amount": T.DecimalType(6, 2), "total": T.DecimalType(10, 2)})
