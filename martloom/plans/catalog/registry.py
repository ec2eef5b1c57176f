"""Query registry, and the SQL text of the input views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_UOL_FROM = """from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join part on l_partkey = p_partkey"""

VIEWS = {
    "uol": f"""select concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) uniq_id,
  o_orderdate date_time, c_nationkey city_id, n_name city_name, o_custkey customer_id,
  split_part(c_name, '#', 1) first_name, split_part(c_name, '#', 2) last_name,
  cast(l_partkey as int) item_id, p_name item_name, cast(l_quantity as bigint) quantity,
  cast(l_extendedprice as decimal(14,2)) payment_amount,
  case l_returnflag when 'R' then 'refunded' when 'N' then 'shipped' end status,
  l_shipdate ship_date, l_partkey part_key, l_suppkey supp_key {_UOL_FROM}""",
    "uol_dirty": f"""select concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) uniq_id,
  o_orderdate date_time, c_nationkey city_id, n_name city_name,
  case when l_linenumber <> 7 then o_custkey end customer_id,
  split_part(c_name, '#', 1) first_name,
  case when l_linenumber = 6 then 'Renamed' else split_part(c_name, '#', 2) end last_name,
  cast(l_partkey as int) item_id,
  case when l_linenumber = 5 then concat('Latest ', p_name) else p_name end item_name,
  cast(l_quantity as bigint) quantity, cast(l_extendedprice as decimal(14,2)) payment_amount,
  case l_returnflag when 'A' then 'TEST-row' when 'R' then 'refunded' when 'N' then 'shipped' end status
  {_UOL_FROM}""",
    "uol_web": """select cast(event_id as varchar) uniq_id, ts date_time, user_id customer_id,
  cast(event_id % 20 as int) item_id, 1 + event_id % 3 quantity,
  cast(value as decimal(14,2)) payment_amount,
  case event_type when 'error' then 'refunded' else 'shipped' end status from events""",
    "ual": """select cast(event_id as varchar) uniq_id, ts date_time,
  cast(case event_type when 'view' then 1 when 'click' then 2 when 'signup' then 3
    when 'purchase' then 4 else 5 end as bigint) action_id,
  user_id customer_id, 1 + event_id % 5 quantity, event_type action from events""",
    "research": """select l_shipdate date_id, p_size category_id, s_nationkey geo_id,
  cast(l_quantity as int) sales_qty, cast(l_extendedprice as decimal(14,2)) sales_amt
  from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey""",
    "price_log": """select timestamp '1995-01-01 00:00:00' datetime, p_size category_id,
  p_type category_name, cast(p_partkey as int) item_id,
  cast(p_retailprice as decimal(10,2)) price from part""",
    "seen": """select cast(date_time as date) d from uol union select cast(date_time as date) from ual
  union select cast(date_id as date) from research""",
    "calendar": "select cast(strftime(d, '%Y%m%d') as int) date_id, d fact_date from seen",
}
_NEEDS = {"seen": ("uol", "ual", "research"), "calendar": ("uol", "ual", "research", "seen")}


def with_views(body: str, *views: str) -> str:
    """``body`` with the named views (and what they need) as common table expressions."""
    names = list(dict.fromkeys(n for v in views for n in (*_NEEDS.get(v, ()), v)))
    ctes = ",\n".join(f"{n} as ({VIEWS[n]})" for n in names)
    return f"with {ctes}\n{body}" if ctes else body


def query(name: str, oracle: str | None = None, views: tuple[str, ...] = ()):
    """Register a (spark, sf_dir) function and the SQL it must agree with."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_views(oracle, *views)
        return fn

    return register
