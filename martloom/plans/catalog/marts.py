"""Dimensions, facts and the retention mart."""

from pyspark.sql import functions as F

from martloom.operators import dimensions as dims
from martloom.operators import facts
from martloom.operators.keys import surrogate_ids
from martloom.plans import inputs
from martloom.plans.catalog.columns import (
    AS_OF, BUSINESS_DATE, HISTORY_END, KEY_SQL, ORDER_KEY_SQL, RATIO_SQL,
)
from martloom.plans.catalog.registry import query
from martloom.session import materialise

BACKFILL = ("1999-01-01", "1999-12-31")


def calendar(spark, sf):
    """The calendar as a run has it: computed once and stored before facts use it."""
    return materialise(dims.d_calendar(
        inputs.order_log(spark, sf, "date_time"), inputs.activity_log(spark, sf), inputs.research(spark, sf)))


def history(spark, sf, *columns):
    """Orders of the first two months: what the dimensions were loaded from so far."""
    rows = inputs.order_log(spark, sf, "date_time", *columns)
    return rows.where(F.col("date_time") < F.lit(HISTORY_END).cast("timestamp_ntz")).select(*columns)


# dimensions

@query("d_calendar", """select cast(strftime(d, '%Y%m%d') as int) date_id, d fact_date,
  cast(extract(day from d) as int) day_num, cast(extract(month from d) as int) month_num,
  strftime(d, '%b') month_name, cast(extract(year from d) as int) year_num
  from seen where d is not null""", ("seen",))
def _(spark, sf):
    return dims.d_calendar(
        inputs.order_log(spark, sf, "date_time"), inputs.activity_log(spark, sf), inputs.research(spark, sf))


@query("d_customer_full", """select customer_id, max(first_name) first_name, max(last_name) last_name,
  max(city_id) city_id from uol_dirty group by customer_id""", ("uol_dirty",))
def _(spark, sf):
    return dims.d_customer_full(
        inputs.order_log(spark, sf, "customer_id", "first_name", "last_name", "city_id", dirty=True))


@query("d_item_full", "select distinct item_id, item_name, 0 category_id from uol_dirty", ("uol_dirty",))
def _(spark, sf):
    return dims.d_item_full(inputs.order_log(spark, sf, "item_id", "item_name", dirty=True))


@query("d_city_full", "select distinct city_id, city_name from uol", ("uol",))
def _(spark, sf):
    return dims.d_city_full(inputs.order_log(spark, sf, "city_id", "city_name"))


@query("d_category", """select distinct category_id, 'category_' || category_id category_name
  from research where category_id is not null""", ("research",))
def _(spark, sf):
    return dims.d_category(inputs.research(spark, sf))


@query("d_customer_new", f"""select customer_id, first_name, last_name, max(city_id) city_id from uol_dirty
  where customer_id not in (select customer_id from uol where date_time < timestamp '{HISTORY_END}')
  group by customer_id, first_name, last_name""", ("uol", "uol_dirty"))
def _(spark, sf):
    orders = inputs.order_log(spark, sf, "customer_id", "first_name", "last_name", "city_id", dirty=True)
    return dims.d_customer_new(orders, history(spark, sf, "customer_id"))


@query("d_city_new", """select city_id, city_name from uol where city_id not in
  (select n_nationkey from nation join region on n_regionkey = r_regionkey where r_name in ('AFRICA', 'AMERICA'))
  group by city_id, city_name""", ("uol",))
def _(spark, sf):
    regions = inputs.table(spark, sf, "region").where(F.col("r_name").isin("AFRICA", "AMERICA"))
    served = inputs.table(spark, sf, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    return dims.d_city_new(
        inputs.order_log(spark, sf, "city_id", "city_name"), served.select(F.col("n_nationkey").alias("city_id")))


@query("d_item_new", f"""select item_id, item_name, 0 category_id from uol_dirty where item_id not in
  (select item_id from uol where date_time < timestamp '{HISTORY_END}') group by item_id, item_name""",
       ("uol", "uol_dirty"))
def _(spark, sf):
    return dims.d_item_new(
        inputs.order_log(spark, sf, "item_id", "item_name", dirty=True), history(spark, sf, "item_id"))


@query("surrogate_ids", """select row_number() over (order by item_id nulls first, item_name nulls first) id,
  item_id, item_name, 0 category_id from (select distinct item_id, item_name from uol_dirty)""", ("uol_dirty",))
def _(spark, sf):
    items = dims.d_item_full(inputs.order_log(spark, sf, "item_id", "item_name", dirty=True))
    return surrogate_ids(items, ["item_id", "item_name"])


# facts

@query("f_activity", f"""select action_id activity_id, {ORDER_KEY_SQL} date_id,
  cast(sum(quantity) as bigint) click_number from ual group by 1, 2""", ("ual",))
def _(spark, sf):
    return facts.f_activity(inputs.activity_log(spark, sf))


@query("f_daily_sales", f"""select {ORDER_KEY_SQL} date_id, item_id, customer_id,
  {RATIO_SQL.format(qty="quantity")} price, cast(sum(quantity) as bigint) quantity,
  cast(sum(payment_amount) as decimal(24,2)) payment_amount from uol group by 1, 2, 3""", ("uol",))
def f_daily_sales(spark, sf):
    return facts.f_daily_sales(
        inputs.order_log(spark, sf, "date_time", "item_id", "customer_id", "quantity", "payment_amount"))


@query("f_research", f"""select {KEY_SQL.format("date_id")} date_id, category_id, geo_id, 0 customer_id,
  0 item_id, cast(sum(sales_qty) as bigint) quantity, cast(sum(sales_amt) as decimal(24,2)) amount
  from research group by {KEY_SQL.format("date_id")}, category_id, geo_id""", ("research",))
def _(spark, sf):
    return facts.f_research(inputs.research(spark, sf))


SALES_COLUMNS = ("date_time", "item_id", "customer_id", "city_id", "quantity", "payment_amount", "status")
SIGNED_SQL = """case when status = 'refunded' then -quantity else quantity end quantity,
  case when status = 'refunded' then -payment_amount else payment_amount end payment_amount"""


@query("f_sales", f"""select c.date_id, item_id, customer_id, city_id, {SIGNED_SQL}
  from uol left join calendar c on cast(date_time as date) = c.fact_date
  where cast(date_time as date) = date '{BUSINESS_DATE}' and (status = 'shipped' or status = 'refunded')""",
       ("calendar",))
def _(spark, sf):
    return facts.f_sales(inputs.order_log(spark, sf, *SALES_COLUMNS), calendar(spark, sf), BUSINESS_DATE)


@query("f_sales_backfill", f"""select c.date_id, item_id, customer_id, city_id, {SIGNED_SQL},
  cast(date_time as date) sale_date
  from uol left join calendar c on cast(date_time as date) = c.fact_date
  where cast(date_time as date) between date '{BACKFILL[0]}' and date '{BACKFILL[1]}'
    and (status = 'shipped' or status = 'refunded')""", ("calendar",))
def _(spark, sf):
    orders = inputs.order_log(spark, sf, *SALES_COLUMNS)
    return facts.f_sales_backfill(orders, calendar(spark, sf), *BACKFILL)


@query("f_daily_sales_signed", f"""select date_id, item_id, customer_id, status, price,
  case when status = 'refunded' then -quantity else quantity end quantity,
  case when status = 'refunded' then -payment_amount else payment_amount end payment_amount from
  (select {ORDER_KEY_SQL} date_id, item_id, customer_id, status, {RATIO_SQL.format(qty="quantity")} price,
    cast(sum(quantity) as bigint) quantity, cast(sum(payment_amount) as decimal(24,2)) payment_amount
   from uol where status in ('shipped', 'refunded') group by 1, 2, 3, 4)""", ("uol",))
def _(spark, sf):
    return facts.f_daily_sales_signed(inputs.order_log(
        spark, sf, "date_time", "item_id", "customer_id", "quantity", "payment_amount", "status"))


def retention_sql(source: str, where: str, period: str, week: str = "") -> str:
    key, out = (f"{week} week_start, ", "week_start, ") if week else ("", "")
    return f"""select {out}item_id, 'weekly' period_name, cast(extract(week from {period}) as int) period_id,
  count(customer_id) filter (n_orders = 1) new_customers_count,
  count(customer_id) filter (n_orders > 1) returning_customers_count,
  count(customer_id) filter (n_refunds > 0) refunded_customer_count,
  cast(sum(if(n_orders = 1, paid, 0)) as decimal(24,2)) new_customers_revenue,
  cast(sum(if(n_orders > 1, paid, 0)) as decimal(24,2)) returning_customers_revenue,
  cast(sum(n_refunds) as bigint) customers_refunded
  from (select {key}customer_id, item_id, count(uniq_id) n_orders, sum(payment_amount) paid,
    count(*) filter (status = 'refunded') n_refunds
    from {source} {where} group by {out}customer_id, item_id)
  group by {out}item_id"""


_WEEK_SQL = f"""where date_time >= date_trunc('week', date '{AS_OF}') - interval 7 day
  and date_time < date_trunc('week', date '{AS_OF}')"""


@query("f_customer_retention", retention_sql("uol_web", _WEEK_SQL, f"date '{AS_OF}'"), ("uol_web",))
def f_customer_retention(spark, sf):
    return facts.f_customer_retention(inputs.web_order_log(spark, sf), AS_OF)


ORDER_WEEK = "cast(date_trunc('week', date_time) as date)"


@query("retention_backfill",
       retention_sql("uol", "", "week_start + interval 7 day", ORDER_WEEK), ("uol",))
def _(spark, sf):
    return facts.retention_backfill(inputs.order_log(
        spark, sf, "date_time", "uniq_id", "customer_id", "item_id", "payment_amount", "status"))


@query("retention_backfill_web",
       retention_sql("uol_web", "", "week_start + interval 7 day", ORDER_WEEK), ("uol_web",))
def _(spark, sf):
    return facts.retention_backfill(inputs.web_order_log(spark, sf))
