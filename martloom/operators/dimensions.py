"""Dimension tables: full rebuild, and the rows an increment adds.

The ``*_new`` operators only ever insert; a stored dimension row is never changed. They
reduce the order log to its distinct candidates before the anti join, which gives the same
rows as filtering first and shuffles far less.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import (
    UNKNOWN_KEY, date_key, day_num, label_concat, month_name, month_num, timestamp_to_date, year_num,
)
from martloom.operators.keys import new_keys_not_in


def union_distinct(*frames: DataFrame) -> DataFrame:
    """UNION of one-column-set frames; each is reduced to its distinct rows first."""
    first, *rest = [f.distinct() for f in frames]
    for f in rest:
        first = first.union(f)
    return first.distinct()


def seen_dates(orders: DataFrame, activity: DataFrame, research: DataFrame) -> DataFrame:
    """Distinct dates of the three logs, a NULL date included if there is one."""
    return union_distinct(
        orders.select(timestamp_to_date("date_time").alias("fact_date")),
        activity.select(timestamp_to_date("date_time").alias("fact_date")),
        research.select(timestamp_to_date("date_id").alias("fact_date")),
    )


def d_calendar(orders: DataFrame, activity: DataFrame, research: DataFrame) -> DataFrame:
    """One row per date that occurs in any log; gaps are not filled."""
    return (
        seen_dates(orders, activity, research)
        .where(F.col("fact_date").isNotNull())
        .select(
            date_key("fact_date").alias("date_id"),
            "fact_date",
            day_num("fact_date").alias("day_num"),
            month_num("fact_date").alias("month_num"),
            month_name("fact_date").alias("month_name"),
            year_num("fact_date").alias("year_num"),
        )
    )


def group_max(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Maximum of each column per key, independently of the others.

    Spark sorts its whole input for a maximum of text. The texts of a key hardly vary, so
    where there are other columns their maximum per (key, texts) is taken first, by hash, and
    only what that leaves is sorted.
    """
    texts = [f.name for f in df.schema if f.name in columns and isinstance(f.dataType, T.StringType)]
    others = [c for c in columns if c not in texts]
    if texts and others:
        df = df.groupBy(*keys, *texts).agg(*[F.max(c).alias(c) for c in others])
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])


def d_customer_full(orders: DataFrame) -> DataFrame:
    """One row per customer; each attribute is its own maximum."""
    return group_max(orders, ["customer_id"], ["first_name", "last_name", "city_id"])


def d_item_full(orders: DataFrame) -> DataFrame:
    return orders.select("item_id", "item_name").distinct().withColumn("category_id", F.lit(UNKNOWN_KEY))


def d_city_full(orders: DataFrame) -> DataFrame:
    return orders.select("city_id", "city_name").distinct()


def d_category(research: DataFrame) -> DataFrame:
    return (
        research.where(F.col("category_id").isNotNull())
        .select("category_id").distinct()
        .withColumn("category_name", label_concat("category_id"))
    )


def d_customer_new(orders: DataFrame, known: DataFrame) -> DataFrame:
    """Unseen customers; a customer seen under two names gives two rows."""
    candidates = orders.groupBy("customer_id", "first_name", "last_name").agg(
        F.max("city_id").alias("city_id")
    )
    return new_keys_not_in(candidates, "customer_id", known)


def d_city_new(orders: DataFrame, known: DataFrame) -> DataFrame:
    return new_keys_not_in(orders.select("city_id", "city_name").distinct(), "city_id", known)


def d_item_new(orders: DataFrame, known: DataFrame) -> DataFrame:
    """Unseen items, with the unknown category (the column admits no NULL)."""
    candidates = orders.select("item_id", "item_name").distinct()
    return new_keys_not_in(candidates, "item_id", known).withColumn("category_id", F.lit(UNKNOWN_KEY))
