"""Registered queries: sales series, summaries, trends and the month calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.dates import month_spine
from ..operators import series as SR
from ..operators import summary as SM
from ..operators.upsert import upsert_months
from ..session import scratch_path
from . import params as P
from .catalog import register
from .q_load import BASE_CTES, TS_NOW, dom, ensure_scratch, full, rng, stored, stored_fact

# Oracle: the detail target over the whole range (all keys valid) with product dims.
FACT = f"""
    select d.id, d.sell_id, d.company_id,
           case when d.product_id in (select id from t_products) then d.product_id end as product_id,
           case when d.shop_id in (select id from t_branches) then d.shop_id end as shop_id,
           coalesce(d.qty, 0) as qty, s.sell_date, {TS_NOW} as created_at
    from v_sell_detail d join v_sell s on d.sell_id = s.id
    where {rng('s.sell_date', P.FULL_START, P.FULL_END)}"""
FACT_DIMS = """
    select f.*, p.brand_id, p.category_id, p.group_id, p.type_id
    from t_fact f left join t_products p on f.product_id = p.id"""
MONTHLY = """
    select shop_id, product_id, cast(date_trunc('month', sell_date) as timestamp) as month,
           cast(sum(qty) as bigint) as qty, count(distinct sell_id) as n_bills, count(*) as n_lines
    from t_fact group by all"""
SERIES_CTES = {**BASE_CTES, "t_fact": FACT, "t_fact_dims": FACT_DIMS, "t_monthly": MONTHLY}

# Dense calendar at the planning grain (shop, product group).
GROUP_MONTHLY = """
    select shop_id, group_id, cast(date_trunc('month', sell_date) as timestamp) as month,
           cast(sum(qty) as bigint) as qty
    from t_fact_dims group by all"""
CALENDAR = f"""
    select cast(m as timestamp) as month
    from generate_series((select min(month) from t_monthly), timestamp '{P.AS_OF[:8]}01', interval 1 month) t(m)"""
DENSE = """
    select k.shop_id, k.group_id, c.month, coalesce(g.qty, 0) as qty
    from (select distinct shop_id, group_id from t_group_monthly) k
    cross join t_calendar c
    left join t_group_monthly g
      on g.shop_id is not distinct from k.shop_id and g.group_id is not distinct from k.group_id
     and g.month = c.month"""
DENSE_CTES = {**SERIES_CTES, "t_group_monthly": GROUP_MONTHLY, "t_calendar": CALENDAR, "t_dense": DENSE}

GROUP_KEYS = ["shop_id", "group_id"]


SUMMARY_KEYS = ["shop_id", "product_id"]


def fact(spark, sf):
    return SR.sales_fact(stored_fact(spark, sf, S.SELL_DETAIL).drop("sell_month"), full(spark, sf).products)


def summary(spark, sf):
    """The stored monthly summary (shop, product, month)."""
    return SM.read(spark, stored(spark, sf).summary)


def dense_groups(spark, sf):
    """Dense series at the planning grain, summed from the stored summary."""
    mon = SR.sales_fact(summary(spark, sf), full(spark, sf).products, ("group_id",))
    mon = mon.groupBy(*GROUP_KEYS, "month").agg(F.sum("qty").alias("qty"))
    return SR.dense_monthly(mon, GROUP_KEYS, stored(spark, sf).first_month or P.AS_OF, P.AS_OF)


@register(
    "sales_monthly_by_shop",
    f"""select shop_id, cast(date_trunc('month', sell_date) as timestamp) as month,
              cast(sum(qty) as bigint) as qty, count(*) as n_lines
       from t_fact group by all""",
    SERIES_CTES,
)
def q_sales_monthly_by_shop(spark, sf):
    """Flagship: the stored sales load (range join + nullify, written by month) summed by shop and month."""
    return summary(spark, sf).groupBy("shop_id", "month").agg(F.sum("qty").alias("qty"), F.sum("n_lines").alias("n_lines"))


@register("sales_monthly_agg", "select * from t_monthly", SERIES_CTES)
def q_sales_monthly_agg(spark, sf):
    return summary(spark, sf)


@register(
    "sales_yearly_agg",
    """select shop_id, product_id, cast(date_trunc('year', month) as timestamp) as year,
              cast(sum(qty) as bigint) as qty, cast(sum(n_bills) as bigint) as n_bills,
              cast(sum(n_lines) as bigint) as n_lines
       from t_monthly group by all""",
    SERIES_CTES,
)
def q_sales_yearly_agg(spark, sf):
    return SR.yearly_from_monthly(summary(spark, sf), SUMMARY_KEYS)


# Incremental upkeep: the fact up to OLD_END is summed, then bills from RELOAD_START on (mid-month) come in late.
@register(
    "agg_incremental",
    "select * from t_monthly",
    SERIES_CTES,
)
def q_agg_incremental(spark, sf):
    from . import loads as L

    ensure_scratch(spark)
    d = dom(spark, sf)
    t = full(spark, sf)
    root = scratch_path(spark, "queries", "incremental")
    for start, end in ((P.FULL_START, P.OLD_END), (P.RELOAD_START, P.FULL_END)):
        batch = L.load_sell_detail(d.v_sell_detail, d.v_sell, start, end, t.branches, t.products, t.suppliers)
        touched = upsert_months(spark, f"{root}/sell_detail", batch, S.SELL_DETAIL, P.NOW, sort_by=["shop_id", "sell_date"])
        SM.refresh(spark, f"{root}/sell_detail", f"{root}/monthly", touched)
    return SM.read(spark, f"{root}/monthly")


@register(
    "sales_filtered",
    """select * from t_fact_dims
       where shop_id in (1, 2, 3, 7) and brand_id in (1, 5, 9, 13, 17, 21, 25) and group_id between 10 and 30""",
    SERIES_CTES,
)
def q_sales_filtered(spark, sf):
    f = fact(spark, sf)
    out = SR.sales_filtered(
        f, {"shop_id": [1, 2, 3, 7], "brand_id": [1, 5, 9, 13, 17, 21, 25], "category_id": None}
    )
    return out.where(F.col("group_id").between(10, 30))


@register(
    "sales_summary",
    """select shop_id, group_id, cast(sum(qty) as bigint) as qty, count(*) as n_lines,
              cast(grouping(shop_id, group_id) as integer) as level
       from t_fact_dims group by rollup (shop_id, group_id)""",
    SERIES_CTES,
)
def q_sales_summary(spark, sf):
    sums = SR.sales_fact(summary(spark, sf), full(spark, sf).products, ("group_id",))
    return SR.sales_summary(sums, "shop_id", "group_id")


@register("sales_history", "select * from t_dense", DENSE_CTES)
def q_sales_history(spark, sf):
    return dense_groups(spark, sf)


@register(
    "sales_trend",
    """select shop_id, group_id, month, qty, prev_month_qty, prev_year_qty,
              round(case when prev_month_qty <> 0 then (qty - prev_month_qty) / prev_month_qty end, 6) as mom_pct,
              round(case when prev_year_qty <> 0 then (qty - prev_year_qty) / prev_year_qty end, 6) as yoy_pct
       from (select *, lag(qty, 1) over w as prev_month_qty, lag(qty, 12) over w as prev_year_qty
             from t_dense window w as (partition by shop_id, group_id order by month))""",
    DENSE_CTES,
)
def q_sales_trend(spark, sf):
    return SR.sales_trend(dense_groups(spark, sf), GROUP_KEYS)


@register(
    "month_spine",
    """select cast(m as timestamp) as month, strftime(m, 'y%Yy%m') as suffix,
              cast(m + interval 1 month as timestamp) as month_end
       from (select unnest(generate_series(date_trunc('month', min(sell_date)),
                                           date_trunc('month', max(sell_date)), interval 1 month)) as m
             from v_sell)""".replace("'y%Yy%m'", "'y%Ym%m'"),
)
def q_month_spine(spark, sf):
    return month_spine(dom(spark, sf).v_sell, "sell_date")
