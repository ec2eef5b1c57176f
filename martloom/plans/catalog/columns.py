"""Column functions, filters, joins and aggregates."""

from pyspark.sql import functions as F

from martloom import functions as fn
from martloom.operators import dimensions as dims
from martloom.operators import facts
from martloom.operators.keys import new_keys_not_in
from martloom.plans import inputs
from martloom.plans.catalog.registry import query

KEY_SQL = "cast(strftime({0}, '%Y%m%d') as int)"
ORDER_KEY_SQL = KEY_SQL.format("date_time")

# dates the history of the incremental queries ends at
HISTORY_END = "1995-03-01"
BUSINESS_DATE = "1999-05-01"
AS_OF = "2024-01-17"


@query("timestamp_to_date", "select uniq_id, cast(date_time as date) fact_date from ual", ("ual",))
def _(spark, sf):
    return inputs.activity_log(spark, sf).select("uniq_id", fn.timestamp_to_date("date_time").alias("fact_date"))


@query("date_key", f"select uniq_id, {ORDER_KEY_SQL} date_id from uol", ("uol",))
def _(spark, sf):
    return inputs.order_log(spark, sf, "uniq_id", "date_time").select(
        "uniq_id", fn.date_key("date_time").alias("date_id"))


@query("date_parts", """select uniq_id, cast(extract(day from date_time) as int) day_num,
  cast(extract(month from date_time) as int) month_num,
  cast(extract(year from date_time) as int) year_num from uol""", ("uol",))
def _(spark, sf):
    return inputs.order_log(spark, sf, "uniq_id", "date_time").select(
        "uniq_id", fn.day_num("date_time").alias("day_num"),
        fn.month_num("date_time").alias("month_num"), fn.year_num("date_time").alias("year_num"))


@query("month_name", "select uniq_id, strftime(date_time, '%b') month_name from uol", ("uol",))
def _(spark, sf):
    return inputs.order_log(spark, sf, "uniq_id", "date_time").select(
        "uniq_id", fn.month_name("date_time").alias("month_name"))


@query("iso_week", "select uniq_id, cast(extract(week from date_time) as int) period_id from uol", ("uol",))
def _(spark, sf):
    return inputs.order_log(spark, sf, "uniq_id", "date_time").select(
        "uniq_id", fn.iso_week("date_time").alias("period_id"))


@query("previous_week_filter", f"""select uniq_id, date_time from uol_web
  where date_time >= date_trunc('week', date '{AS_OF}') - interval 7 day
    and date_time < date_trunc('week', date '{AS_OF}')""", ("uol_web",))
def _(spark, sf):
    rows = inputs.web_order_log(spark, sf).select("uniq_id", "date_time")
    return rows.where(fn.previous_week_filter("date_time", AS_OF))


@query("business_date_filter", f"""select uniq_id, date_time, item_id from uol
  where cast(date_time as date) = date '{BUSINESS_DATE}'""", ("uol",))
def _(spark, sf):
    rows = inputs.order_log(spark, sf, "uniq_id", "date_time", "item_id")
    return rows.where(fn.business_date_filter("date_time", BUSINESS_DATE))


@query("status_filter", """select uniq_id, status from uol_dirty
  where status = 'shipped' or status = 'refunded'""", ("uol_dirty",))
def _(spark, sf):
    return inputs.order_log(spark, sf, "uniq_id", "status", dirty=True).where(fn.status_filter("status"))


@query("refund_sign", """select uniq_id, status,
  case when status = 'refunded' then -quantity else quantity end quantity,
  case when status = 'refunded' then -payment_amount else payment_amount end payment_amount
  from uol""", ("uol",))
def _(spark, sf):
    rows = inputs.order_log(spark, sf, "uniq_id", "status", "quantity", "payment_amount")
    return rows.select(
        "uniq_id", "status", fn.refund_sign("quantity", "status").alias("quantity"),
        fn.refund_sign("payment_amount", "status").alias("payment_amount"))


# the quotient at two digits, half away from zero, on whole cents (all amounts are >= 0)
RATIO_SQL = """cast(cast((2*cast(sum(payment_amount)*100 as bigint)+cast(sum({qty}) as bigint))
  // (2*nullif(cast(sum({qty}) as bigint),0)) as decimal(18,0))*0.01 as decimal(24,2))"""


@query("safe_ratio", "select item_id, " + RATIO_SQL.format(qty="sold") + """ price from
  (select item_id, payment_amount, case when status = 'shipped' then quantity else 0 end sold from uol_web)
  group by item_id""", ("uol_web",))
def _(spark, sf):
    sold = F.when(F.col("status") == fn.SHIPPED, F.col("quantity")).otherwise(F.lit(0))
    price = fn.safe_ratio(F.sum("payment_amount"), F.sum(sold)).cast(facts.MONEY)
    return inputs.web_order_log(spark, sf).groupBy("item_id").agg(price.alias("price"))


@query("label_concat", """select date_id, category_id, 'category_' || category_id category_name
  from research""", ("research",))
def _(spark, sf):
    return inputs.research(spark, sf).select(
        "date_id", "category_id", fn.label_concat("category_id").alias("category_name"))


@query("constant_columns", """select item_id, item_name, 0 category_id, 0 customer_id,
  'weekly' period_name from uol""", ("uol",))
def _(spark, sf):
    unknown = F.lit(fn.UNKNOWN_KEY)
    return inputs.order_log(spark, sf, "item_id", "item_name").select(
        "item_id", "item_name", unknown.alias("category_id"), unknown.alias("customer_id"),
        F.lit(fn.PERIOD_WEEKLY).alias("period_name"))


@query("null_predicates", """select uniq_id, customer_id is null no_customer, status is not null has_status
  from uol_dirty where customer_id is null or status is not null""", ("uol_dirty",))
def _(spark, sf):
    rows = inputs.order_log(spark, sf, "uniq_id", "customer_id", "status", dirty=True)
    no_customer, has_status = F.col("customer_id").isNull(), F.col("status").isNotNull()
    return rows.where(no_customer | has_status).select(
        "uniq_id", no_customer.alias("no_customer"), has_status.alias("has_status"))


@query("test_text_match", """select uniq_id, lower(coalesce(status, '')) like '%test%' test_status,
  lower(coalesce(item_name, '')) like '%test%' test_item from uol_dirty""", ("uol_dirty",))
def _(spark, sf):
    return inputs.order_log(spark, sf, "uniq_id", "status", "item_name", dirty=True).select(
        "uniq_id", fn.is_test_text("status").alias("test_status"), fn.is_test_text("item_name").alias("test_item"))


# joins

@query("left_join_calendar", """select c.date_id, u.uniq_id, u.date_time from uol u left join
  (select distinct cast(strftime(date_id, '%Y%m%d') as int) date_id, cast(date_id as date) fact_date
   from research where date_id >= timestamp '1996-01-01') c on cast(u.date_time as date) = c.fact_date""",
       ("uol", "research"))
def _(spark, sf):
    shipped = inputs.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("fact_date"))
    calendar = shipped.where(F.col("fact_date") >= F.lit("1996-01-01").cast("date")).distinct()
    calendar = calendar.select(fn.date_key("fact_date").alias("date_id"), "fact_date")
    return facts.left_join_calendar(inputs.order_log(spark, sf, "uniq_id", "date_time"), calendar)


@query("new_keys_not_in", f"""select uniq_id, customer_id from uol_dirty where customer_id not in
  (select customer_id from uol where date_time < timestamp '{HISTORY_END}')""", ("uol", "uol_dirty"))
def _(spark, sf):
    known = inputs.order_log(spark, sf, "customer_id", "date_time").where(
        F.col("date_time") < F.lit(HISTORY_END).cast("timestamp_ntz"))
    rows = inputs.order_log(spark, sf, "uniq_id", "customer_id", dirty=True)
    return new_keys_not_in(rows, "customer_id", known.select("customer_id"))


# aggregates and set operations

@query("select_distinct", "select distinct city_id, city_name, status from uol", ("uol",))
def _(spark, sf):
    return inputs.order_log(spark, sf, "city_id", "city_name", "status").distinct()


@query("group_no_agg", "select item_id, item_name from uol_dirty group by item_id, item_name", ("uol_dirty",))
def _(spark, sf):
    return inputs.order_log(spark, sf, "item_id", "item_name", dirty=True).dropDuplicates(["item_id", "item_name"])


@query("group_max", """select customer_id, max(last_name) last_name, max(city_id) city_id, max(item_name) item_name
  from uol_dirty group by customer_id""", ("uol_dirty",))
def _(spark, sf):
    rows = inputs.order_log(spark, sf, "customer_id", "last_name", "city_id", "item_name", dirty=True)
    return dims.group_max(rows, ["customer_id"], ["last_name", "city_id", "item_name"])


@query("group_sum", f"""select {ORDER_KEY_SQL} date_id, city_id, cast(sum(quantity) as bigint) quantity,
  cast(sum(payment_amount) as decimal(24,2)) payment_amount from uol group by 1, 2""", ("uol",))
def _(spark, sf):
    rows = inputs.order_log(spark, sf, "date_time", "city_id", "quantity", "payment_amount")
    return rows.groupBy(fn.date_key("date_time").alias("date_id"), "city_id").agg(
        F.sum("quantity").alias("quantity"), F.sum("payment_amount").cast(facts.MONEY).alias("payment_amount"))


@query("count_forms", """select item_id, count(*) row_count, count(customer_id) with_customer,
  count(status) with_status from uol_dirty group by item_id""", ("uol_dirty",))
def _(spark, sf):
    rows = inputs.order_log(spark, sf, "item_id", "customer_id", "status", dirty=True)
    return rows.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("customer_id").alias("with_customer"),
        F.count("status").alias("with_status"))


@query("conditional_agg", """select item_id, count(case when status = 'refunded' then customer_id end) refunds,
  cast(sum(case when status = 'shipped' then payment_amount else 0 end) as decimal(24,2)) shipped_amount
  from uol group by item_id""", ("uol",))
def _(spark, sf):
    rows = inputs.order_log(spark, sf, "item_id", "customer_id", "status", "payment_amount")
    status = F.col("status")
    shipped = F.when(status == fn.SHIPPED, F.col("payment_amount")).otherwise(0)
    return rows.groupBy("item_id").agg(
        F.count(F.when(status == fn.REFUNDED, F.col("customer_id"))).alias("refunds"),
        F.sum(shipped).cast(facts.MONEY).alias("shipped_amount"))


@query("two_level_agg", """select item_id, count(case when n = 1 then customer_id end) single_buyers,
  count(case when n > 1 then customer_id end) repeat_buyers, cast(sum(total) as decimal(24,2)) total from
  (select customer_id, item_id, count(uniq_id) n, sum(payment_amount) total from uol group by 1, 2)
  group by item_id""", ("uol",))
def _(spark, sf):
    rows = inputs.order_log(spark, sf, "customer_id", "item_id", "uniq_id", "payment_amount")
    per_customer = rows.groupBy("customer_id", "item_id").agg(
        F.count("uniq_id").alias("n"), F.sum("payment_amount").alias("total"))
    customer = F.col("customer_id")
    return per_customer.groupBy("item_id").agg(
        F.count(F.when(F.col("n") == 1, customer)).alias("single_buyers"),
        F.count(F.when(F.col("n") > 1, customer)).alias("repeat_buyers"),
        F.sum("total").cast(facts.MONEY).alias("total"))


@query("union_distinct", "select d fact_date from seen", ("seen",))
def _(spark, sf):
    return dims.seen_dates(
        inputs.order_log(spark, sf, "date_time"), inputs.activity_log(spark, sf), inputs.research(spark, sf))
