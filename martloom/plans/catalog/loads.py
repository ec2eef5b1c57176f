"""Sources, sinks, cleaning and whole runs: written to the shared scratch folder, read back."""

from functools import partial

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import as_date, timestamp_to_date
from martloom.operators import cleaning
from martloom.operators.keys import surrogate_ids
from martloom.plans import inputs, runs
from martloom.plans.catalog.columns import ORDER_KEY_SQL, RATIO_SQL
from martloom.plans.catalog.marts import ORDER_WEEK, retention_sql
from martloom.plans.catalog.registry import query
from martloom.plans.enforce import BROKEN, enforced, read_quarantined
from martloom.plans.stream import stream_to_marts
from martloom.schemas import TABLES
from martloom.session import delete, scratch_path, tidy
from martloom.sources.csv_files import (
    CORRUPT, FILE, POSITION, REJECTED, infer_and_cast, nan_to_null, read_csv_by_name, read_full_csv, read_increment_csv, read_routed,
    route_rejects, split_rejects,
)
from martloom.sources.key_index import KeyIndex
from martloom.sources.landing import Landing
from martloom.sources.warehouse import (
    Warehouse, add_column, append_table, merge_evolved, overwrite_table, replace_partitions,
)
from martloom.streaming import stream_ingest

UOL = ", ".join(inputs.ORDER_COLUMNS)
UAL = "uniq_id, date_time, action_id, customer_id, quantity, action"
EVOLVED = "1998-01-01"

# one folder per dataset with the increments below it, so that one write job lands them all
PARTITIONED_LAYOUT = "{root}/{dataset}/increment={increment}"


def _kept(df, label, *partition_by):
    """The rows, written once to the scratch folder, for queries that read the same joins several times."""
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def _write_csv(df, path, partition_by=(), **options):
    # as text, with microseconds where there are any
    text = {f.name: F.col(f.name).cast("string") for f in df.schema if f.dataType.typeName() == "timestamp_ntz"}
    with tidy(df.sparkSession):
        df.withColumns(text).write.partitionBy(*partition_by).options(header=True, escape='"', **options).csv(path)


# sources

@query("read_full_csv", """select date_time, city_id, city_name, customer_id, first_name, last_name, item_id,
  item_name, quantity, payment_amount from uol_dirty""", ("uol_dirty",))
def _(spark, sf):
    path = scratch_path(spark, "full") + "/user_order_log.csv"
    _write_csv(inputs.order_log(spark, sf, dirty=True), path)
    return read_full_csv(spark, path, "user_order_log")


@query("read_csv_multiline", """select date_time, city_id, city_name, customer_id, first_name, last_name, item_id,
  case when item_id % 3 = 0 then replace(item_name, ' ', chr(10)) when item_id % 3 = 1 then concat('"', item_name, chr(13), chr(10), '"x') else item_name end
  item_name, quantity, payment_amount from uol""", ("uol",))
def _(spark, sf):
    # line breaks and quotes in item names
    path = scratch_path(spark, "full") + "/user_order_log.csv"
    name, kind = F.col("item_name"), F.col("item_id") % 3
    broken = F.when(kind == 0, F.replace(name, F.lit(" "), F.lit("\n"))).when(
        kind == 1, F.concat(F.lit('"'), name, F.lit('\r\n"x'))).otherwise(name)
    _write_csv(inputs.order_log(spark, sf).withColumn("item_name", broken), path)
    return read_full_csv(spark, path, "user_order_log", multiline=True)


@query("read_increment_csv", f"""select strftime(date_time, '%Y') increment, uniq_id, date_time, city_id,
  city_name, customer_id, first_name, last_name, item_id, item_name, quantity, payment_amount,
  case when date_time >= timestamp '{EVOLVED}' then status end status from uol""", ("uol",))
def _(spark, sf):
    # old increments lack the status column, new ones have another column order
    landing = Landing(scratch_path(spark, "landing"), PARTITIONED_LAYOUT)
    orders = _kept(inputs.order_log(spark, sf).withColumn("increment", F.year("date_time").cast("string")), "orders")
    new = F.col("date_time") >= F.lit(EVOLVED).cast("timestamp_ntz")
    folder = f"{landing.root}/user_order_log"
    old_rows, new_rows = orders.where(~new).drop("status"), orders.where(new)
    _write_csv(old_rows, folder, ["increment"])
    reordered = new_rows.select(*reversed(inputs.ORDER_COLUMNS), "increment")
    reordered = reordered.withColumn("date_time", F.date_format("date_time", "yyyy-MM-dd HH:mm:ss"))
    reordered.write.mode("append").partitionBy("increment").options(header=True, escape='"').csv(folder)
    # one row per year that has landed
    years = [r["increment"] for r in orders.select("increment").distinct().orderBy("increment").collect()]
    return read_increment_csv(spark, landing, "user_order_log", years).drop(FILE, POSITION)


@query("project_named_columns", "select customer_id, date_time, action_id, quantity from ual", ("ual",))
def _(spark, sf):
    return cleaning.project_named_columns(
        inputs.activity_log(spark, sf), ["customer_id", "date_time", "action_id", "quantity"])


@query("infer_and_cast", """select o_orderdate date_time, cast(l_partkey as int) item_id,
  cast(l_quantity as bigint) quantity, cast(l_extendedprice as decimal(14,2)) payment_amount
  from lineitem join orders on l_orderkey = o_orderkey where l_returnflag <> 'A'""")
def _(spark, sf):
    # quantities arrive as "17.0"; the order number of some rows is text and they are rejected
    lines = inputs.table(spark, sf, "lineitem")
    rows = lines.join(inputs.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    part = F.col("l_partkey").cast("string")
    text = rows.select(
        F.col("o_orderdate").cast("string").alias("date_time"),
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("P"), part)).otherwise(part).alias("item_id"),
        F.col("l_quantity").cast("string").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(14,2)").cast("string").alias("payment_amount"),
    )
    accepted, _rejected = split_rejects(
        infer_and_cast(text, TABLES["staging.user_order_log"].schema, on_error="flag"))
    return accepted


@query("infer_and_cast_rejects", """select cast(l_quantity as bigint) quantity,
  case l_returnflag when 'A' then 'item_id' end rejected, case when l_returnflag <> 'A' then cast(l_partkey as int) end item_id,
  count(*) row_count from lineitem group by all""")
def _(spark, sf):
    # one scan and one write deal the rows to an accepted and a rejected folder
    source, target = scratch_path(spark, "lines"), scratch_path(spark, "routed")
    part = F.col("l_partkey").cast("string")
    _write_csv(inputs.table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("P"), part)).otherwise(part).alias("item_id"),
        F.col("l_quantity").alias("quantity")), f"{source}/user_order_log.csv")
    raw = read_csv_by_name(spark, f"{source}/user_order_log.csv").drop(FILE, POSITION)
    route_rejects(infer_and_cast(raw, TABLES["staging.user_order_log"].schema, on_error="flag"), target)
    accepted, rejected = read_routed(spark, target)
    both = accepted.withColumn("rejected", F.lit(None).cast("string")).unionByName(
        rejected.withColumn("rejected", F.concat_ws(",", REJECTED)).drop(REJECTED, CORRUPT))
    return both.groupBy("quantity", "rejected", "item_id").agg(F.count(F.lit(1)).alias("row_count"))


@query("nan_to_null", """select l_orderkey, l_linenumber,
  case when l_returnflag = 'R' then l_linestatus end item_name from lineitem""")
def _(spark, sf):
    flag = F.col("l_returnflag")
    rows = inputs.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(flag == "A", "N/A").when(flag == "N", "nan").otherwise(F.col("l_linestatus")).alias("item_name"))
    return nan_to_null(rows, ["item_name"])


@query("drop_if_present", f"select {UAL} from ual", ("ual",))
def _(spark, sf):
    rows = inputs.activity_log(spark, sf).withColumn("id", F.monotonically_increasing_id())
    return cleaning.drop_if_present(cleaning.drop_if_present(rows, "id"), "id")


@query("read_table", "select datetime, category_id, category_name, item_id, price from price_log", ("price_log",))
def _(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    wh.overwrite("staging.price_log", inputs.price_log(spark, sf).withColumn(
        "load_date", F.lit("2024-01-01").cast("date")))
    return wh.read("staging.price_log").drop("load_date")


# sinks and schema evolution

@query("overwrite_table", "select date_id, category_id, geo_id, sales_qty, sales_amt from research", ("research",))
def _(spark, sf):
    path = scratch_path(spark, "overwrite")
    rows = inputs.research(spark, sf)
    overwrite_table(rows, path)
    # a second load whose plan reads the table it replaces
    overwrite_table(spark.read.schema(rows.schema).parquet(path), path, reads_target=True)
    return spark.read.schema(rows.schema).parquet(path)


@query("append_table", """select datetime, category_id, category_name, item_id, price from price_log
  union all select datetime, category_id, category_name, item_id, price from price_log""", ("price_log",))
def _(spark, sf):
    path = scratch_path(spark, "append")
    rows = inputs.price_log(spark, sf)
    append_table(rows, path)
    append_table(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@query("replace_partitions", f"""select {UAL}, cast(date_time as date) load_date from ual
  where action <> 'error' or date_time < timestamp '2024-01-15'""", ("ual",))
def _(spark, sf):
    # a rerun of the second half of the month replaces those dates and no others
    path = scratch_path(spark, "replace")
    rows = inputs.activity_log(spark, sf).withColumn("load_date", timestamp_to_date("date_time"))
    replace_partitions(rows, path, "load_date")
    later = F.col("load_date") >= F.lit("2024-01-15").cast("date")
    replace_partitions(rows.where(later & (F.col("action") != "error")), path, "load_date")
    return spark.read.schema(rows.schema).parquet(path)


@query("add_column", f"""select {UOL.replace('status', 'cast(null as varchar) status')} from uol
  where date_time < timestamp '{EVOLVED}' union all
  select {UOL} from uol where date_time >= timestamp '{EVOLVED}'""", ("uol",))
def _(spark, sf):
    orders = inputs.order_log(spark, sf)
    new = F.col("date_time") >= F.lit(EVOLVED).cast("timestamp_ntz")
    old = add_column(orders.where(~new).drop("status"), "status", "string")
    return merge_evolved(old, orders.where(new))


@query("default_missing_column", """select uniq_id, 'shipped' status from ual
  union all select uniq_id, status from uol""", ("ual", "uol"))
def _(spark, sf):
    absent = cleaning.default_missing_column(inputs.activity_log(spark, sf).select("uniq_id"))
    present = cleaning.default_missing_column(inputs.order_log(spark, sf, "uniq_id", "status"))
    return absent.unionByName(present)


@query("load_history", """select 7 batch_id, t target_table, true finished, n row_count from
  (select 'staging.user_activity_log' t, count(*) n from events union all select 'staging.price_log', 2 * count(*) from part)""")
def _(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    day = F.lit("2024-01-31").cast("date")
    activity = inputs.activity_log(spark, sf).withColumn("load_date", timestamp_to_date("date_time"))
    wh.replace("staging.user_activity_log", activity, batch_id=7)
    prices = inputs.price_log(spark, sf).withColumn("load_date", day)
    # a repeated load of the batch replaces its row
    wh.append("staging.price_log", prices, batch_id=7)
    wh.append("staging.price_log", prices.union(prices), batch_id=7)
    return wh.read("mart.load_history").select(
        F.col("batch_id").cast("int").alias("batch_id"), "target_table",
        (F.col("finish_load") >= F.col("start_load")).alias("finished"), "row_count")


_TABLE_SIZES = {
    "staging.price_log": "(select count(*) from part)",
    "mart.d_city": "(select count(*) from nation)",
    "mart.d_customer": "(select count(*) from customer)",
}


@query("create_tables", " union all ".join(
    f"select '{t}' table_name, {len(spec.columns)} column_count, {_TABLE_SIZES.get(t, '0')} row_count"
    for t, spec in TABLES.items()))
def _(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    wh.create_tables()
    wh.append("staging.price_log", inputs.price_log(spark, sf).withColumn("load_date", F.current_date()))
    nation, customer = inputs.table(spark, sf, "nation"), inputs.table(spark, sf, "customer")
    wh.append("mart.d_city", nation.select(
        F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city_name")))
    wh.append("mart.d_customer", customer.select(
        F.col("c_custkey").alias("customer_id"), F.substring_index("c_name", "#", 1).alias("first_name"),
        F.substring_index("c_name", "#", -1).alias("last_name"), F.col("c_nationkey").alias("city_id")))
    out = None
    for name in TABLES:
        rows = wh.read(name)
        one = rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(len(rows.columns)).alias("column_count"), "row_count")
        out = one if out is None else out.unionAll(one)
    return out


# row cleaning

@query("dedup_keep_first", f"""select {UOL} from (select *, row_number() over
  (partition by uniq_id order by ship_date, part_key, supp_key) n from uol) where n = 1""", ("uol",))
def dedup_keep_first(spark, sf):
    rows = inputs.order_log(spark, sf, *inputs.ORDER_COLUMNS, *inputs.LINE_ORDER)
    return cleaning.dedup_keep_first(rows, ["uniq_id"], inputs.LINE_ORDER).select(*inputs.ORDER_COLUMNS)


@query("dedup_against_history", f"""select uniq_id, date_time, customer_id from uol u where not exists
  (select 1 from uol h where h.uniq_id = u.uniq_id and h.date_time < timestamp '{EVOLVED}')""", ("uol",))
def _(spark, sf):
    rows = inputs.order_log(spark, sf, "uniq_id", "date_time", "customer_id")
    staged = rows.where(F.col("date_time") < F.lit(EVOLVED).cast("timestamp_ntz"))
    return cleaning.dedup_against_history(rows, staged)


@query("stream_ingest", f"select {UAL} from ual", ("ual",))
def _(spark, sf):
    # every event lands twice, in different files
    landed, target = scratch_path(spark, "landed"), scratch_path(spark, "streamed")
    rows = inputs.activity_log(spark, sf)
    rows.write.parquet(landed)
    rows.write.mode("append").parquet(landed)
    stream_ingest(
        spark, landed, rows.schema, target, scratch_path(spark, "offsets"), across_files=True, files_per_batch=1,
    ).awaitTermination()
    return spark.read.schema(rows.schema).parquet(target).drop("batch_id")


# whole runs

def _rebuilt(spark, sf):
    """The warehouse after a full rebuild from whole-history files, compressed ones, which go once they are staged."""
    source, packed = scratch_path(spark, "source"), {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    runs.side_by_side([partial(_write_csv, rows, f"{source}/{name}.csv", **packed) for name, rows in (
        ("user_order_log", inputs.order_log(spark, sf)), ("user_activity_log", inputs.activity_log(spark, sf)),
        ("customer_research", inputs.research(spark, sf)),
    )])
    return runs.run_full(
        spark, source, scratch_path(spark, "warehouse"), "2024-01-31", batch_id=1, staged=partial(delete, spark, source))


@query("full_rebuild_daily_sales", f"""select date_id, item_id, cast(customer_id as int) customer_id,
  cast(price as decimal(10,2)) price, quantity, cast(payment_amount as decimal(10,2)) payment_amount from
  (select {ORDER_KEY_SQL} date_id, item_id, customer_id, {RATIO_SQL.format(qty="quantity")} price,
    cast(sum(quantity) as bigint) quantity, sum(payment_amount) payment_amount from uol group by 1, 2, 3)""", ("uol",))
def _(spark, sf):
    return _rebuilt(spark, sf).read("mart.f_daily_sales")


@query("full_rebuild_customers", """select row_number() over (order by customer_id) id, cast(customer_id as int) customer_id,
  max(first_name) first_name, max(last_name) last_name, cast(max(city_id) as int) city_id from uol group by customer_id""", ("uol",))
def _(spark, sf):
    return _rebuilt(spark, sf).read("mart.d_customer")


@query("full_rebuild", """select 'mart.d_calendar' table_name, count(*) row_count from seen
  union all select 'mart.d_customer', count(distinct customer_id) from uol
  union all select 'mart.d_item', count(*) from (select distinct item_id, item_name from uol)
  union all select 'mart.d_city', count(*) from (select distinct city_id, city_name from uol)
  union all select 'mart.d_category', count(distinct category_id) from research
  union all select 'mart.f_activity', count(*) from (select distinct action_id, cast(date_time as date) from ual)
  union all select 'mart.f_daily_sales', count(*) from
    (select distinct cast(date_time as date), item_id, customer_id from uol)
  union all select 'mart.f_research', count(*) from
    (select distinct cast(date_id as date), category_id, geo_id from research)""", ("seen",))
def _(spark, sf):
    wh = _rebuilt(spark, sf)
    out = None
    for name in runs.REBUILT:
        if name.startswith("mart."):
            one = wh.read(name).agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count")
            out = one if out is None else out.unionAll(one)
    return out


_WEB_CITY = """(select w.*, c_nationkey city_id, strftime(w.date_time, '%Y-%m-%d') increment
  from uol_web w join customer on w.customer_id = c_custkey)"""


def _landed_web_logs(spark, sf):
    """A landing with one increment per day of the web logs, and those days in order."""
    landing = Landing(scratch_path(spark, "landing"), PARTITIONED_LAYOUT)
    customer, part = inputs.table(spark, sf, "customer"), inputs.table(spark, sf, "part")
    nation = inputs.table(spark, sf, "nation")
    orders = (
        inputs.web_order_log(spark, sf)
        .join(customer, F.col("customer_id") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(part, F.col("item_id") == F.col("p_partkey"))
        .select(
            "uniq_id", "date_time", F.col("c_nationkey").alias("city_id"), F.col("n_name").alias("city_name"),
            "customer_id", F.substring_index("c_name", "#", 1).alias("first_name"),
            F.substring_index("c_name", "#", -1).alias("last_name"), "item_id",
            F.col("p_name").alias("item_name"), "quantity", "payment_amount", "status")
    )
    activity = inputs.activity_log(spark, sf)
    day = timestamp_to_date("date_time").cast("timestamp_ntz")
    research = activity.groupBy(day.alias("date_id")).agg(
        F.min("action_id").cast("int").alias("category_id"), F.count_distinct("customer_id").cast("int").alias("geo_id"),
        F.sum("quantity").cast("int").alias("sales_qty"), F.count(F.lit(1)).cast("decimal(14,2)").alias("sales_amt"))
    # a price line for every item sold on a day
    sold = orders.select(day.alias("datetime"), "item_id").distinct()
    prices = sold.join(inputs.price_log(spark, sf).drop("datetime"), "item_id")
    def land(name, rows, stamp):
        dated = rows.withColumn("increment", F.date_format(stamp, "yyyy-MM-dd"))
        _write_csv(dated, f"{landing.root}/{name}", ["increment"])

    runs.side_by_side([partial(land, *dataset) for dataset in (
        ("user_order_log", orders, "date_time"), ("user_activity_log", activity, "date_time"),
        ("customer_research", research, "date_id"), ("price_log", prices, "datetime"),
    )])
    days = [r["increment"] for r in activity.select(
        F.date_format("date_time", "yyyy-MM-dd").alias("increment")).distinct().orderBy("increment").collect()]
    return landing, days


@query("backfill_run", f"""select cast(strftime(date_time, '%Y%m%d') as int) date_id, item_id, customer_id, city_id,
  case when status = 'refunded' then -quantity else quantity end quantity,
  case when status = 'refunded' then -payment_amount else payment_amount end payment_amount,
  cast(date_time as date) sale_date from {_WEB_CITY}""", ("uol_web",))
def _(spark, sf):
    landing, days = _landed_web_logs(spark, sf)
    wh = runs.run_backfill(
        spark, landing, scratch_path(spark, "warehouse"), days[0], days[-1], batch_id=1)
    return wh.read("mart.f_sales").withColumn("customer_id", F.col("customer_id").cast("bigint"))


def _daily_runs(spark, sf):
    """The warehouse after a back-fill of all days but the last two and daily runs of these."""
    landing, days = _landed_web_logs(spark, sf)
    root = scratch_path(spark, "warehouse")
    runs.run_backfill(spark, landing, root, days[0], days[-3])
    for day in days[-2:]:
        wh = runs.run_increment(spark, landing, root, day)
    return wh


@query("increment_run_sales", f"""select cast(strftime(date_time, '%Y%m%d') as int) date_id, item_id, customer_id, city_id,
  case when status = 'refunded' then -quantity else quantity end quantity,
  case when status = 'refunded' then -payment_amount else payment_amount end payment_amount,
  cast(date_time as date) sale_date from {_WEB_CITY}""", ("uol_web",))
def _(spark, sf):
    return _daily_runs(spark, sf).read("mart.f_sales")


_LAST = "(select date_trunc('week', max(date_time)) from uol_web)"


@query("increment_run_retention", f"""select week_start, item_id, period_name, period_id,
  cast(new_customers_count as int) new_customers_count, cast(returning_customers_count as int) returning_customers_count,
  cast(refunded_customer_count as int) refunded_customer_count,
  cast(new_customers_revenue as decimal(10,2)) new_customers_revenue,
  cast(returning_customers_revenue as decimal(10,2)) returning_customers_revenue,
  cast(customers_refunded as int) customers_refunded from
  ({retention_sql(_WEB_CITY, f"where date_time < {_LAST}", "week_start + interval 7 day", ORDER_WEEK)})""", ("uol_web",))
def _(spark, sf):
    # daily runs write the week before theirs; the last week is none's yet, and holds what the back-fill knew
    week = F.date_trunc("week", inputs.web_order_log(spark, sf).select(F.max("date_time")).scalar()).cast("date")
    marts = _daily_runs(spark, sf).read("mart.f_customer_retention")
    return marts.where(F.col("week_start") < week)


@query("increment_run_customers", f"""select distinct cast(customer_id as int) customer_id,
  split_part(c_name, '#', 1) first_name, split_part(c_name, '#', 2) last_name, cast(city_id as int) city_id
  from {_WEB_CITY} join customer on customer_id = c_custkey""", ("uol_web",))
def _(spark, sf):
    return _daily_runs(spark, sf).read("mart.d_customer").drop("id")


_SIGNED_DAILY = f"""select cast(strftime(date_time, '%Y%m%d') as int) date_id, item_id, customer_id, status,
  cast({RATIO_SQL.format(qty="quantity")} as decimal(14,2)) price,
  cast(sum(case when status = 'refunded' then -quantity else quantity end) as bigint) quantity,
  cast(sum(case when status = 'refunded' then -payment_amount else payment_amount end) as decimal(14,2)) payment_amount,
  cast(date_time as date) sale_date"""


@query("increment_run_daily_sales", f"{_SIGNED_DAILY} from uol_web group by 1, 2, 3, 4, 8", ("uol_web",))
def _(spark, sf):
    # the last increment is loaded twice, which must not count it twice
    landing, days = _landed_web_logs(spark, sf)
    root = scratch_path(spark, "warehouse")
    runs.run_backfill(spark, landing, root, days[0], days[-2])
    for _ in range(2):
        wh = runs.run_increment(spark, landing, root, days[-1])
    return wh.read("mart.f_daily_sales_signed")


def _streamed(spark, sf):
    """The warehouse after a stream of all orders, which land a second time with the increment of the day after."""
    landing, _ = _landed_web_logs(spark, sf)
    folder = f"{landing.root}/user_order_log"
    again = spark.read.options(header=True, escape='"', inferSchema=False).csv(folder)
    day_after = F.date_add(F.col("increment").cast("date"), 1).cast("string")
    again.withColumn("increment", day_after).write.mode("append").partitionBy("increment").options(
        header=True, escape='"').csv(folder)
    root = scratch_path(spark, "warehouse")
    stream_to_marts(spark, landing, root, scratch_path(spark, "offsets"), files_per_batch=300).awaitTermination()
    return Warehouse(spark, root)


@query("stream_to_marts", f"""select cast(strftime(date_time, '%Y%m%d') as int) date_id, item_id, customer_id, city_id,
  case when status = 'refunded' then -quantity else quantity end quantity,
  case when status = 'refunded' then -payment_amount else payment_amount end payment_amount,
  cast(date_time as date) sale_date from {_WEB_CITY}""", ("uol_web",))
def _(spark, sf):
    return _streamed(spark, sf).read("mart.f_sales")


@query("stream_to_daily_sales", f"{_SIGNED_DAILY} from uol_web group by 1, 2, 3, 4, 8", ("uol_web",))
def _(spark, sf):
    return _streamed(spark, sf).read("mart.f_daily_sales_signed")


@query("constraint_gate", """with item as (select p_partkey, p_name, p_partkey % 10 = 0 twice, p_partkey % 10 = 1 stored from part)
  select 'd_item' table_name, 'primary_key:item_id' broken, cast(count(*) + count_if(twice) as bigint) row_count from item where twice or stored
  union all select 'd_item', null, count(*) from item where not twice and not stored
  union all select 'sales', case when twice then 'foreign_key:item_id' end, count(*) from lineitem join item on l_partkey = p_partkey group by 2""")
def _(spark, sf):
    # a tenth of the items is stored already, another tenth comes under two names; orders refer to all of them
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    wh.create_tables()
    item = inputs.table(spark, sf, "part").select(
        F.col("p_partkey").cast("int").alias("item_id"), F.col("p_name").alias("item_name"), F.lit(0).alias("category_id"))
    day = timestamp_to_date(F.lit("2024-01-01").cast("timestamp_ntz"))
    stored = item.where("item_id % 10 = 1").withColumn("id", F.col("item_id").cast("bigint"))
    wh.append("mart.d_item", stored)
    wh.keys("mart.d_item").add(stored)
    calendar = spark.range(1).select(F.lit(20240101).alias("date_id"), F.lit(1).alias("customer_id"))
    wh.keys("mart.d_calendar").add(calendar)
    wh.keys("mart.d_customer").add(calendar)
    renamed = item.where("item_id % 10 = 0").withColumn("item_name", F.lit("another name"))
    check_date = as_date("2024-01-01")
    new = enforced(wh, "mart.d_item", item.union(renamed), check_date, "quarantine")
    wh.append("mart.d_item", surrogate_ids(new, ["item_id"], existing=wh.read("mart.d_item")))
    wh.keys("mart.d_item").add(new)
    sales = inputs.table(spark, sf, "lineitem").select(
        F.lit(20240101).alias("date_id"), F.col("l_partkey").cast("int").alias("item_id"), F.lit(1).cast("bigint").alias("customer_id"),
        F.lit(1).alias("city_id"), F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("payment_amount"), day.alias("sale_date"))
    wh.replace("mart.f_sales", enforced(wh, "mart.f_sales", sales, check_date, "quarantine"))

    def counted(name, rows, broken):
        return rows.groupBy(broken.alias("broken")).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "broken", "row_count")

    none, why = F.lit(None).cast("string"), F.concat_ws(",", BROKEN)
    return (counted("d_item", wh.read("mart.d_item").where("item_id % 10 <> 1"), none)
            .unionAll(counted("d_item", read_quarantined(wh, "mart.d_item"), why))
            .unionAll(counted("sales", wh.read("mart.f_sales"), none))
            .unionAll(counted("sales", read_quarantined(wh, "mart.f_sales"), why)))


@query("dedup_against_index", f"""select uniq_id, date_time, customer_id from uol u where not exists
  (select 1 from uol h where h.uniq_id = u.uniq_id and h.date_time >= timestamp '1996-01-01' and h.date_time < timestamp '{EVOLVED}')""", ("uol",))
def _(spark, sf):
    # keys staged by one load a year; the window looks at the loads of 1996 and later
    rows = inputs.order_log(spark, sf, "uniq_id", "date_time", "customer_id")
    rows = _kept(rows.withColumn("year", F.year("date_time")), "rows", "year")
    index = KeyIndex(spark, scratch_path(spark, "index"), [T.StructField("uniq_id", T.StringType())], "load_date")
    for year in range(1992, int(EVOLVED[:4])):
        index.replace(rows.where(F.col("year") == year), f"{year}-01-01")
    return cleaning.dedup_against_index(rows.drop("year"), index, since="1996-01-01")
