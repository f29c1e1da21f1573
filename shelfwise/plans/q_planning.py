"""Registered queries: forecasts, orders, recommendations, stock views, rebalancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.dates import month_partition_filter
from ..operators import forecast as FC
from ..operators import planning as PL
from ..session import scratch_path
from . import params as P
from .catalog import register
from .q_load import STOCK_CTES, full, stored_fact
from .q_series import DENSE_CTES, GROUP_KEYS, dense_groups

AS_OF_MONTH = P.AS_OF[:8] + "01"
AS_OF_TS = f"timestamp '{AS_OF_MONTH} 00:00:00'"
W = "(partition by shop_id, group_id order by month)"

PCT = f"""
    select *, case when lag(qty, 1) over {W} <> 0
                   then (qty - lag(qty, 1) over {W}) / lag(qty, 1) over {W} end as pct
    from t_dense"""
SMA = f"""
    select shop_id, group_id, month, qty, round(pct, 6) as pct, round(sma, 6) as sma,
           round(qty * (1 + sma), 6) as forecast
    from (select *, avg(pct) over (partition by shop_id, group_id order by month
                                   rows between {P.SMA_N - 1} preceding and current row) as sma
          from t_pct)"""
WAG = f"""
    select shop_id, group_id, month, qty, round(pct, 6) as pct, round(wag, 6) as wag,
           round(qty * (1 + wag), 6) as forecast
    from (select *, (coalesce(pct * 3, 0) + coalesce(p1 * 2, 0) + coalesce(p2 * 1, 0))
                    / nullif((case when pct is not null then 3.0 else 0.0 end)
                           + (case when p1 is not null then 2.0 else 0.0 end)
                           + (case when p2 is not null then 1.0 else 0.0 end), 0) as wag
          from (select *, lag(pct, 1) over {W} as p1, lag(pct, 2) over {W} as p2 from t_pct))"""
YOY = f"""
    select shop_id, group_id, month, qty, round(growth, 6) as growth, round(growth_avg, 6) as growth_avg,
           round(avg_qty, 6) as avg_qty, round(qty * (1 + growth_avg), 6) as estimate
    from (select *,
                 avg(growth) over (partition by shop_id, group_id, moy order by yr
                                   rows between {P.YOY_YEARS - 1} preceding and current row) as growth_avg,
                 avg(qty) over (partition by shop_id, group_id, moy order by yr
                                rows between {P.YOY_YEARS - 1} preceding and current row) as avg_qty
          from (select *, case when lag(qty) over (partition by shop_id, group_id, moy order by yr) <> 0
                               then (qty - lag(qty) over (partition by shop_id, group_id, moy order by yr))
                                    / lag(qty) over (partition by shop_id, group_id, moy order by yr) end as growth
                from (select *, month(month) as moy, year(month) as yr from t_dense)))"""
STOCK_GRP = """
    select s.shop_id, p.group_id, cast(sum(s.qty) as bigint) as current_stock
    from t_stock s join t_products p on s.product_id = p.id group by all"""
TARGET_MAX = "select shop_id, product_group_id as group_id, max_qty as target_max from t_setting_latest"
ORDERS = f"""
    select coalesce(a.shop_id, b.shop_id) as shop_id, coalesce(a.group_id, b.group_id) as group_id,
           a.forecast as forecast_sma, b.forecast as forecast_wag
    from (select * from t_sma where month = {AS_OF_TS}) a
    full join (select * from t_wag where month = {AS_OF_TS}) b
      on a.shop_id is not distinct from b.shop_id and a.group_id is not distinct from b.group_id"""
ORDER_QTY = """
    select o.shop_id, o.group_id, forecast_sma, forecast_wag,
           coalesce(t.target_max, 0.0) as target_max, cast(coalesce(g.current_stock, 0) as bigint) as current_stock,
           round(coalesce(t.target_max, 0.0) * forecast_sma + forecast_sma - coalesce(g.current_stock, 0), 6) as order_sma,
           round(coalesce(t.target_max, 0.0) * forecast_wag + forecast_wag - coalesce(g.current_stock, 0), 6) as order_wag
    from t_orders o
    left join t_target_max t on o.shop_id = t.shop_id and o.group_id = t.group_id
    left join t_stock_grp g on o.shop_id = g.shop_id and o.group_id = g.group_id"""
YOY_ORDERS = f"""
    select y.shop_id, y.group_id, y.estimate as forecast_est, y.avg_qty as forecast_avg,
           coalesce(t.target_max, 0.0) as target_max, cast(coalesce(g.current_stock, 0) as bigint) as current_stock,
           round(coalesce(t.target_max, 0.0) * y.estimate + y.estimate - coalesce(g.current_stock, 0), 6) as order_est,
           round(coalesce(t.target_max, 0.0) * y.avg_qty + y.avg_qty - coalesce(g.current_stock, 0), 6) as order_avg
    from (select * from t_yoy where month = {AS_OF_TS}) y
    left join t_target_max t on y.shop_id = t.shop_id and y.group_id = t.group_id
    left join t_stock_grp g on y.shop_id = g.shop_id and y.group_id = g.group_id"""
REORDER = """
    select coalesce(o.shop_id, y.shop_id) as shop_id, coalesce(o.group_id, y.group_id) as group_id,
           o.forecast_sma, o.order_sma, o.forecast_wag, o.order_wag,
           y.forecast_est, y.order_est, y.forecast_avg, y.order_avg
    from t_order_qty o full join t_yoy_orders y
      on o.shop_id is not distinct from y.shop_id and o.group_id is not distinct from y.group_id"""
REORDER_LONG = """
    select shop_id, group_id, 'SMA' as method, forecast_sma as forecast, order_sma as order_qty from t_reorder_wide
    union all select shop_id, group_id, 'WAG', forecast_wag, order_wag from t_reorder_wide
    union all select shop_id, group_id, 'YOY_EST', forecast_est, order_est from t_reorder_wide
    union all select shop_id, group_id, 'YOY_AVG', forecast_avg, order_avg from t_reorder_wide"""
RECOMMEND = f"""
    select * from (
        select shop_id, group_id, method, forecast, order_qty, recommended_qty,
               cast(row_number() over (partition by shop_id order by recommended_qty desc, group_id) as integer) as rank
        from (select *, cast(ceil(round(order_qty * (1 + {P.SAFETY_FACTOR_PCT} / 100.0), 6)) as bigint) as recommended_qty
              from t_reorder where method = 'WAG' and order_qty > 0))
    where rank <= {P.TOP_K}"""

PLAN_CTES = {
    **STOCK_CTES,
    **DENSE_CTES,
    "t_pct": PCT,
    "t_sma": SMA,
    "t_wag": WAG,
    "t_yoy": YOY,
    "t_stock_grp": STOCK_GRP,
    "t_target_max": TARGET_MAX,
    "t_orders": ORDERS,
    "t_order_qty": ORDER_QTY,
    "t_yoy_orders": YOY_ORDERS,
    "t_reorder_wide": REORDER,
    "t_reorder": REORDER_LONG,
    "t_recommend": RECOMMEND,
}


def _inputs(spark, sf):
    t = full(spark, sf)
    dense = dense_groups(spark, sf)
    return t, dense, PL.stock_by_group(t.stock_balance, t.products)


def _table(spark, sf):
    return FC.forecast_table(dense_groups(spark, sf), GROUP_KEYS, P.SMA_N, P.YOY_YEARS)


def _sma(spark, sf):
    return FC.forecast_sma(dense_groups(spark, sf), GROUP_KEYS, P.SMA_N)


def _wag(spark, sf):
    return FC.forecast_wag(dense_groups(spark, sf), GROUP_KEYS, P.WAG_N)


def _yoy(spark, sf):
    return FC.forecast_yoy(dense_groups(spark, sf), GROUP_KEYS, P.YOY_YEARS)


def _plan(spark, sf):
    t, _, sg = _inputs(spark, sf)
    return PL.plan_orders(_table(spark, sf), t.stock_targets, sg, AS_OF_MONTH)


def _orders(spark, sf):
    return PL.order_qty(_plan(spark, sf))


def _yoy_orders(spark, sf):
    return PL.yoy_orders(_plan(spark, sf))


def _reorder(spark, sf):
    return PL.calculate_reorder(_plan(spark, sf))


def _recommend(spark, sf):
    return PL.recommend_purchase(_reorder(spark, sf), "WAG", P.SAFETY_FACTOR_PCT, P.TOP_K).select(
        "shop_id", "group_id", "method", "forecast", "order_qty", "recommended_qty", "rank"
    )


@register("forecast_sma", "select * from t_sma", PLAN_CTES)
def q_forecast_sma(spark, sf):
    return _sma(spark, sf)


@register("forecast_wag", "select * from t_wag", PLAN_CTES)
def q_forecast_wag(spark, sf):
    return _wag(spark, sf)


@register("forecast_yoy", "select * from t_yoy", PLAN_CTES)
def q_forecast_yoy(spark, sf):
    return _yoy(spark, sf)


@register("order_qty", "select * from t_order_qty", PLAN_CTES)
def q_order_qty(spark, sf):
    return _orders(spark, sf)


@register("yoy_orders", "select * from t_yoy_orders", PLAN_CTES)
def q_yoy_orders(spark, sf):
    return _yoy_orders(spark, sf)


@register(
    "safety_factor",
    f"""select shop_id, group_id, order_sma, order_wag,
              round(order_sma * (1 + {P.SAFETY_FACTOR_PCT} / 100.0), 6) as safe_order_sma,
              round(order_wag * (1 + {P.SAFETY_FACTOR_PCT} / 100.0), 6) as safe_order_wag
       from t_order_qty""",
    PLAN_CTES,
)
def q_safety_factor(spark, sf):
    o = _orders(spark, sf)
    return o.select(
        "shop_id", "group_id", "order_sma", "order_wag",
        PL.safety_factor(F.col("order_sma"), P.SAFETY_FACTOR_PCT).alias("safe_order_sma"),
        PL.safety_factor(F.col("order_wag"), P.SAFETY_FACTOR_PCT).alias("safe_order_wag"),
    )


@register("calculate_reorder", "select * from t_reorder", PLAN_CTES)
def q_calculate_reorder(spark, sf):
    return _reorder(spark, sf)


@register("recommend_purchase", "select * from t_recommend", PLAN_CTES)
def q_recommend_purchase(spark, sf):
    return _recommend(spark, sf)


@register(
    "purchase_proposal",
    f"""select 'P-{P.AS_OF.replace('-', '')}-' || cast(shop_id as varchar) as proposal_id, shop_id,
              string_agg(cast(group_id as varchar) || ':' || cast(recommended_qty as varchar), ';' order by rank) as lines,
              count(*) as n_lines, cast(sum(recommended_qty) as bigint) as total_qty, 'proposed' as status
       from t_recommend group by shop_id""",
    PLAN_CTES,
)
def q_purchase_proposal(spark, sf):
    path = scratch_path(spark, "queries", "proposals")
    made = PL.purchase_proposal(_recommend(spark, sf), P.AS_OF)
    PL.append_proposals(made, path)
    p = spark.read.schema(made.schema).parquet(path)
    return p.withColumn("lines", PL.proposal_text(F.col("lines")))


@register(
    "forecast_compare",
    """select shop_id, group_id, method, mae, mape, n_points,
              cast(rank() over (partition by shop_id, group_id order by mae asc nulls last, method) as integer) as rank
       from (select shop_id, group_id, method, round(sum(cast(round(abs(forecast - actual) * 1000000) as bigint)) / count(*) / 1000000.0, 6) as mae,
                    round(avg(case when actual <> 0 then abs(forecast - actual) / actual end), 6) as mape,
                    count(*) as n_points
             from (select shop_id, group_id, month, 'SMA' as method, forecast,
                          lead(qty, 1) over (partition by shop_id, group_id order by month) as actual from t_sma
                   union all
                   select shop_id, group_id, month, 'WAG', forecast,
                          lead(qty, 1) over (partition by shop_id, group_id order by month) from t_wag
                   union all
                   select shop_id, group_id, month, 'YOY', estimate,
                          lead(qty, 12) over (partition by shop_id, group_id order by month) from t_yoy)
             where forecast is not null and actual is not null
             group by all)""",
    PLAN_CTES,
)
def q_forecast_compare(spark, sf):
    return FC.forecast_compare(dense_groups(spark, sf), GROUP_KEYS, P.SMA_N, P.YOY_YEARS)


@register(
    "stock_balance_view",
    """select s.shop_id, b.name as shop_name, s.product_id, p.description, p.group_id, p.type_id, s.qty
       from t_stock s left join t_branches b on s.shop_id = b.id left join t_products p on s.product_id = p.id""",
    PLAN_CTES,
)
def q_stock_balance_view(spark, sf):
    t = full(spark, sf)
    return PL.stock_balance_view(t.stock_balance, t.branches, t.products)


@register(
    "low_stock",
    """select g.shop_id, g.group_id, g.current_stock, t.min_qty, t.max_qty,
              round(t.min_qty - g.current_stock, 6) as gap
       from t_stock_grp g join t_setting_latest t on g.shop_id = t.shop_id and g.group_id = t.product_group_id
       where g.current_stock < t.min_qty""",
    PLAN_CTES,
)
def q_low_stock(spark, sf):
    t, _, sg = _inputs(spark, sf)
    return PL.low_stock(sg, t.stock_targets)


@register(
    "overstock",
    """select g.shop_id, g.group_id, g.current_stock, t.min_qty, t.max_qty,
              round(g.current_stock - t.max_qty, 6) as excess
       from t_stock_grp g join t_setting_latest t on g.shop_id = t.shop_id and g.group_id = t.product_group_id
       where g.current_stock > t.max_qty""",
    PLAN_CTES,
)
def q_overstock(spark, sf):
    t, _, sg = _inputs(spark, sf)
    return PL.overstock(sg, t.stock_targets)


# ---------------------------------------------------------------------------
# Stock balance planning columns and inter-branch rebalancing
# ---------------------------------------------------------------------------
def _day(offset: int) -> str:
    import datetime as dt

    return (dt.date.fromisoformat(P.AS_OF) + dt.timedelta(days=offset)).isoformat()


SOLD = f"""
    select shop_id, product_id,
           cast(sum(case when sell_date >= timestamp '{_day(-6)} 00:00:00' then qty else 0 end) as double)
               as truesell_qty_7_day,
           cast(sum(qty) as double) as truesell_qty_30_day
    from t_fact
    where sell_date >= timestamp '{_day(-29)} 00:00:00' and sell_date < timestamp '{_day(1)} 00:00:00'
      and shop_id is not null and product_id is not null
    group by all"""
COVER_BASE = """
    select s.shop_id, s.product_id, p.type_id, s.qty, cast(s.qty as double) as current_qty,
           coalesce(w.truesell_qty_7_day, 0.0) as t7, coalesce(w.truesell_qty_30_day, 0.0) as t30,
           coalesce(t.min_qty, 0.0) as mn, coalesce(t.max_qty, 0.0) as mx,
           coalesce(t.sell_multiply, 0.0) as sm, coalesce(t.show_qty, 0.0) as sq
    from t_stock s
    left join t_products p on s.product_id = p.id
    left join t_sold w on s.shop_id = w.shop_id and s.product_id = w.product_id
    left join t_setting_latest t on s.shop_id = t.shop_id and p.group_id = t.product_group_id"""
COVER = """
    select shop_id, product_id, qty, current_qty, t7 as truesell_qty_7_day, t30 as truesell_qty_30_day,
           mn as min_qty, mx as max_qty,
           round(t7 * sm + sq, 6) as target_qty_7_day_original,
           round(least(greatest(t7 * sm + sq, mn), mx), 6) as target_qty_7_day,
           round(t30 * sm + sq, 6) as target_qty_30_day_original,
           round(least(greatest(t30 * sm + sq, mn), mx), 6) as target_qty_30_day,
           type_id
    from t_cover_base"""
RB_J = """
    select coalesce(s.shop_id, w.shop_id) as shop_id, coalesce(s.product_id, w.product_id) as product_id,
           coalesce(cast(s.qty as double), 0.0) as stock, coalesce(w.truesell_qty_30_day, 0.0) as need
    from t_stock s full join t_sold w on s.shop_id = w.shop_id and s.product_id = w.product_id"""
RB_SI = """
    select product_id, shop_id,
           sum(amt) over (partition by product_id order by shop_id rows unbounded preceding) - amt as lo,
           sum(amt) over (partition by product_id order by shop_id rows unbounded preceding) as hi
    from (select product_id, shop_id, stock - need as amt from t_rb_j where stock - need > 0)"""
RB_DI = """
    select product_id, shop_id,
           sum(amt) over (partition by product_id order by shop_id rows unbounded preceding) - amt as lo,
           sum(amt) over (partition by product_id order by shop_id rows unbounded preceding) as hi
    from (select product_id, shop_id, need - stock as amt from t_rb_j where need - stock > 0)"""
REBALANCE = """
    select si.product_id, si.shop_id as from_shop, di.shop_id as to_shop,
           round(sum(least(si.hi, di.hi) - greatest(si.lo, di.lo)), 6) as transfer_qty
    from t_rb_si si join t_rb_di di on si.product_id = di.product_id and si.lo < di.hi and di.lo < si.hi
    group by all"""
COVER_CTES = {
    **PLAN_CTES, "t_sold": SOLD, "t_cover_base": COVER_BASE, "t_cover": COVER,
    "t_rb_j": RB_J, "t_rb_si": RB_SI, "t_rb_di": RB_DI,
}


def _sold(spark, sf):
    # The windows' months prune the stored details.
    details = stored_fact(spark, sf, S.SELL_DETAIL).where(month_partition_filter(_day(-29), _day(0)))
    return PL.true_sell_windows(details, P.AS_OF)


@register("true_sell_windows", "select * from t_sold", COVER_CTES)
def q_true_sell_windows(spark, sf):
    return _sold(spark, sf)


@register(
    "target_cover",
    """select shop_id, product_id, qty, current_qty, truesell_qty_7_day, truesell_qty_30_day, min_qty, max_qty,
              target_qty_7_day_original, target_qty_7_day, target_qty_30_day_original, target_qty_30_day,
              sum(current_qty) over (partition by shop_id, type_id) as current_qty_by_type,
              round(sum(target_qty_7_day) over (partition by shop_id, type_id), 6) as target_qty_by_type_7_day,
              round(sum(target_qty_30_day) over (partition by shop_id, type_id), 6) as target_qty_by_type_30_day
       from t_cover""",
    COVER_CTES,
)
def q_target_cover(spark, sf):
    t = full(spark, sf)
    from ..operators.keys import known_rows

    nb, nt = known_rows(t.branches), known_rows(t.types)
    bound = nb * nt if nb is not None and nt is not None else None
    return PL.target_cover(t.stock_balance, _sold(spark, sf), t.products, t.stock_targets, bound)


@register("rebalance_stock", REBALANCE, COVER_CTES)
def q_rebalance_stock(spark, sf):
    return PL.rebalance_stock(full(spark, sf).stock_balance, _sold(spark, sf))
