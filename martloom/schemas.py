"""Declared tables: column types, keys and length limits.

Spark enforces none of the constraints; ``martloom.operators.constraints`` checks
them and ``conform`` applies the column types on write.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import UNKNOWN_KEY


_TYPES = {
    "int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(), "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(), "decimal(14,2)": T.DecimalType(14, 2),
    "decimal(10,2)": T.DecimalType(10, 2), "decimal(24,2)": T.DecimalType(24, 2),
}


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str
    unknown_keys: tuple = ()


@dataclass(frozen=True)
class TableSpec:
    name: str
    ddl: str
    primary_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    varchar: dict[str, int] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()
    serial: str | None = None
    optional: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        # StructType.fromDDL would need a running session
        fields = [f.split(" ") for f in self.ddl.split(", ")]
        return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def data_columns(self) -> list[str]:
        """Columns a source file may carry: no surrogate id, no load partition."""
        return [c for c in self.columns if c != self.serial and c not in self.partition_by]

    @property
    def decimals(self) -> dict[str, T.DecimalType]:
        return {f.name: f.dataType for f in self.schema if isinstance(f.dataType, T.DecimalType)}


_CALENDAR_FK = ForeignKey("date_id", "mart.d_calendar", "date_id")
_ITEM_FK = ForeignKey("item_id", "mart.d_item", "item_id")
_CUSTOMER_FK = ForeignKey("customer_id", "mart.d_customer", "customer_id")


def _with_unknown(fk: ForeignKey) -> ForeignKey:
    return ForeignKey(fk.column, fk.parent, fk.parent_column, (UNKNOWN_KEY,))


_SPECS = [
    TableSpec(
        "staging.customer_research",
        "id bigint, date_id timestamp_ntz, category_id int, geo_id int, sales_qty int, "
        "sales_amt decimal(14,2), load_date date",
        primary_key=("id",), serial="id", partition_by=("load_date",),
    ),
    TableSpec(
        "staging.user_activity_log",
        "id bigint, uniq_id string, date_time timestamp_ntz, action_id bigint, customer_id bigint, "
        "quantity bigint, action string, load_date date",
        primary_key=("id",), not_null=("date_time", "action_id", "customer_id"), serial="id",
        optional=("uniq_id", "action"), partition_by=("load_date",),
    ),
    TableSpec(
        "staging.user_order_log",
        "id bigint, uniq_id string, date_time timestamp_ntz, city_id int, city_name string, "
        "customer_id bigint, first_name string, last_name string, item_id int, item_name string, "
        "quantity bigint, payment_amount decimal(14,2), status string, load_date date",
        primary_key=("id",), not_null=("date_time",), serial="id",
        varchar={"city_name": 100, "first_name": 100, "last_name": 100, "item_name": 100, "status": 50},
        optional=("uniq_id", "status"), partition_by=("load_date",),
    ),
    TableSpec(
        "staging.price_log",
        "datetime timestamp_ntz, category_id int, category_name string, item_id int, "
        "price decimal(10,2), load_date date",
        partition_by=("load_date",),
    ),
    # which business dates each load holds, written with the load
    TableSpec(
        "staging.load_manifest", "dataset string, business_date date, row_count bigint, load_date date",
        primary_key=("dataset", "business_date", "load_date"), not_null=("dataset", "row_count"),
        partition_by=("load_date",),
    ),
    TableSpec(
        "mart.d_customer",
        "id bigint, customer_id int, first_name string, last_name string, city_id int",
        primary_key=("customer_id",), not_null=("id",), serial="id",
        varchar={"first_name": 15, "last_name": 15},
    ),
    TableSpec(
        "mart.d_city", "id bigint, city_id int, city_name string",
        primary_key=("id",), serial="id", varchar={"city_name": 50},
    ),
    TableSpec(
        "mart.d_item", "id bigint, item_id int, item_name string, category_id int",
        primary_key=("item_id",), not_null=("id", "category_id"), serial="id",
        varchar={"item_name": 50},
    ),
    TableSpec(
        "mart.d_category", "id bigint, category_id int, category_name string",
        primary_key=("id",), not_null=("category_id",), serial="id", varchar={"category_name": 50},
    ),
    TableSpec(
        "mart.d_calendar",
        "date_id int, fact_date date, day_num int, month_num int, month_name string, year_num int",
        primary_key=("date_id",), not_null=("fact_date",), varchar={"month_name": 8},
    ),
    TableSpec(
        "mart.f_activity", "activity_id int, date_id int, click_number int",
        primary_key=("activity_id", "date_id"), not_null=("activity_id", "date_id"),
        foreign_keys=(_CALENDAR_FK,),
    ),
    TableSpec(
        "mart.f_daily_sales",
        "date_id int, item_id int, customer_id int, price decimal(10,2), quantity bigint, "
        "payment_amount decimal(10,2)",
        primary_key=("date_id", "item_id", "customer_id"),
        not_null=("date_id", "item_id", "customer_id"),
        foreign_keys=(_CALENDAR_FK, _ITEM_FK, _CUSTOMER_FK),
    ),
    TableSpec(
        "mart.f_sales",
        "date_id int, item_id int, customer_id bigint, city_id int, quantity bigint, "
        "payment_amount decimal(14,2), sale_date date",
        foreign_keys=(_CALENDAR_FK, _ITEM_FK, _CUSTOMER_FK), partition_by=("sale_date",),
    ),
    # what each load adds to the sales of its business dates
    TableSpec(
        "mart.daily_sales_part",
        "sale_date date, item_id int, customer_id bigint, status string, quantity bigint, "
        "payment_amount decimal(24,2), load_date date",
        partition_by=("load_date",),
    ),
    TableSpec(
        "mart.f_daily_sales_signed",
        "date_id int, item_id int, customer_id bigint, status string, price decimal(14,2), quantity bigint, "
        "payment_amount decimal(14,2), sale_date date",
        primary_key=("date_id", "item_id", "customer_id", "status"),
        foreign_keys=(_CALENDAR_FK, _ITEM_FK, _CUSTOMER_FK), partition_by=("sale_date",),
    ),
    TableSpec(
        "mart.f_research",
        "date_id int, category_id int, geo_id int, customer_id int, item_id int, quantity bigint, "
        "amount decimal(10,2)",
        primary_key=("date_id", "category_id", "geo_id"),
        not_null=("date_id", "category_id", "geo_id", "customer_id", "item_id"),
        foreign_keys=(_CALENDAR_FK, _with_unknown(_ITEM_FK), _with_unknown(_CUSTOMER_FK)),
    ),
    TableSpec(
        "mart.f_customer_retention",
        "new_customers_count int, returning_customers_count int, refunded_customer_count int, "
        "period_name string, period_id int, item_id int, new_customers_revenue decimal(10,2), "
        "returning_customers_revenue decimal(10,2), customers_refunded int, week_start date",
        varchar={"period_name": 50}, partition_by=("week_start",),
    ),
    TableSpec(
        "mart.load_history",
        "start_load timestamp_ntz, finish_load timestamp_ntz, row_count bigint, batch_id bigint, target_table string",
        primary_key=("batch_id", "target_table"), varchar={"target_table": 50},
        partition_by=("batch_id", "target_table"),
    ),
    TableSpec(
        "dq_checks_results",
        "table_name string, check_name string, check_date date, check_result int",
    ),
]

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}


def strict_cast(column: str, source: T.DataType, target: T.DataType) -> Column:
    """Cast that stops the job on a value the target type cannot hold.

    The same under ``spark.sql.ansi.enabled`` true and false.
    """
    c = F.col(column)
    if source == target:
        return c
    cast = c.try_cast(target)
    message = F.concat(F.lit(f"{column} does not fit {target.simpleString()}: "), c.cast("string"))
    return (
        F.when(c.isNotNull() & cast.isNull(), F.raise_error(message).cast(target))
        .otherwise(cast)
        .alias(column)
    )


def conform(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """Declared columns in declared order and type; absent optional ones are NULL."""
    spec = TABLES[table] if isinstance(table, str) else table
    source = {f.name: f.dataType for f in df.schema}
    out = []
    for f in spec.schema:
        if f.name in source:
            out.append(strict_cast(f.name, source[f.name], f.dataType).alias(f.name))
        elif f.name in spec.optional or f.name == spec.serial:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"{spec.name}: column {f.name} is missing")
    return df.select(*out)
