"""The shop's logs as views over the benchmark tables.

``order_log`` joins only the tables its requested columns come from: every order line has
its order, customer, nation and part, so leaving a join out changes no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_columns() -> dict:
    returnflag = F.col("l_returnflag")
    return {
        "uniq_id": F.concat(
            F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")
        ),
        "date_time": F.col("o_orderdate"),
        "city_id": F.col("c_nationkey"),
        "city_name": F.col("n_name"),
        "customer_id": F.col("o_custkey"),
        "first_name": F.substring_index("c_name", "#", 1),
        "last_name": F.substring_index("c_name", "#", -1),
        "item_id": F.col("l_partkey").cast("int"),
        "item_name": F.col("p_name"),
        "quantity": F.col("l_quantity").cast("bigint"),
        "payment_amount": F.col("l_extendedprice").cast("decimal(14,2)"),
        "status": F.when(returnflag == "R", "refunded").when(returnflag == "N", "shipped"),
        # file order of repeated lines
        "ship_date": F.col("l_shipdate"),
        "part_key": F.col("l_partkey"),
        "supp_key": F.col("l_suppkey"),
    }


def _dirty_columns() -> dict:
    line, flag, clean = F.col("l_linenumber"), F.col("l_returnflag"), _order_columns()
    return {
        **clean,
        "customer_id": F.when(line != 7, clean["customer_id"]),
        "last_name": F.when(line == 6, "Renamed").otherwise(clean["last_name"]),
        "item_name": F.when(line == 5, F.concat(F.lit("Latest "), F.col("p_name"))).otherwise(clean["item_name"]),
        "status": F.when(flag == "A", "TEST-row").otherwise(clean["status"]),
    }


ORDER_COLUMNS = (
    "uniq_id", "date_time", "city_id", "city_name", "customer_id", "first_name", "last_name",
    "item_id", "item_name", "quantity", "payment_amount", "status",
)
LINE_ORDER = ("ship_date", "part_key", "supp_key")


def order_log(spark: SparkSession, sf_dir: str, *columns: str, dirty: bool = False) -> DataFrame:
    """Order log with the requested (default: all) columns; ``dirty`` breaks some rows."""
    columns = columns or ORDER_COLUMNS
    exprs = _dirty_columns() if dirty else _order_columns()
    wanted = set(columns)
    rows = table(spark, sf_dir, "lineitem")
    # lines are shuffled while they are narrow: parts bring one column, orders and customers the others
    if "item_name" in wanted:
        rows = rows.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if wanted & {"date_time", "customer_id", "city_id", "city_name", "first_name", "last_name"}:
        orders = table(spark, sf_dir, "orders")
        # customers meet the orders, of which there are fewer than lines
        if wanted & {"city_id", "city_name", "first_name", "last_name"}:
            orders = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        if "city_name" in wanted:
            orders = orders.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(*[exprs[c].alias(c) for c in columns])


def web_order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order log with dense weeks, from the event stream."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("uniq_id"),
        F.col("ts").alias("date_time"),
        F.col("user_id").alias("customer_id"),
        (F.col("event_id") % 20).cast("int").alias("item_id"),
        (F.lit(1) + F.col("event_id") % 3).alias("quantity"),
        F.col("value").cast("decimal(14,2)").alias("payment_amount"),
        F.when(F.col("event_type") == "error", "refunded").otherwise("shipped").alias("status"),
    )


def activity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("uniq_id"),
        F.col("ts").alias("date_time"),
        F.when(kind == "view", 1).when(kind == "click", 2).when(kind == "signup", 3)
        .when(kind == "purchase", 4).otherwise(5).cast("bigint").alias("action_id"),
        F.col("user_id").alias("customer_id"),
        (F.lit(1) + F.col("event_id") % 5).alias("quantity"),
        kind.alias("action"),
    )


def research(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_shipdate").alias("date_id"),
            F.col("p_size").alias("category_id"),
            F.col("s_nationkey").alias("geo_id"),
            F.col("l_quantity").cast("int").alias("sales_qty"),
            F.col("l_extendedprice").cast("decimal(14,2)").alias("sales_amt"),
        )
    )


def price_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("datetime"),
        F.col("p_size").alias("category_id"),
        F.col("p_type").alias("category_name"),
        F.col("p_partkey").cast("int").alias("item_id"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )
