"""Stock planning: orders from forecasts, recommendations, proposals, stock views,
sold-quantity windows, target cover and inter-branch rebalancing.

Grain rule: targets are kept per (shop, product group) while stock is per
(shop, product). Stock and sales are summed up to (shop, group) *before* they
meet a target — never join the finer grain to the target (it multiplies).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import ts_lit
from .keys import bounded_broadcast, known_rows

PLAN_KEYS = ("shop_id", "group_id")


def _target_cols(targets: DataFrame) -> DataFrame:
    return targets.select(
        "shop_id", F.col("product_group_id").alias("group_id"), "min_qty", "max_qty", "sell_multiply", "show_qty"
    )


def stock_by_group(stock: DataFrame, products: DataFrame, group_col: str = "group_id") -> DataFrame:
    """Stock summed from (shop, product) to (shop, group)."""
    p = bounded_broadcast(products.select(F.col("id").alias("_pid"), F.col(group_col).alias("group_id")),
                          upper_bound=known_rows(products))
    s = stock.join(p, stock["product_id"] == F.col("_pid"), "inner")
    return s.groupBy("shop_id", "group_id").agg(F.sum("qty").alias("current_stock"))


def order_formula(target_max: Column, forecast: Column, stock: Column) -> Column:
    """``(TargetMax * Forecast + Forecast) - CurrentStock``; may be negative (not clamped)."""
    return F.round(target_max * forecast + forecast - stock, 6)


def _latest(df: DataFrame, month: str) -> DataFrame:
    return df.where(F.col("month") == ts_lit(f"{month} 00:00:00"))


def plan_orders(ft: DataFrame, targets: DataFrame, stock_grp: DataFrame, as_of_month: str,
                keys: Sequence[str] = PLAN_KEYS) -> DataFrame:
    """Every method's forecast and order per (shop, group) for the planning month.

    One row per key of the forecast table at ``as_of_month`` (a partition-local
    filter), joined to the target maximum and the stock summed to the same
    grain. Missing target -> TargetMax 0; missing stock -> 0.
    """
    f = _latest(ft, as_of_month).select(
        *keys, "forecast_sma", "forecast_wag", F.col("estimate").alias("forecast_est"),
        F.col("avg_qty").alias("forecast_avg"),
    )
    t = _target_cols(targets).select("shop_id", "group_id", F.col("max_qty").alias("target_max"))
    j = f.join(t, list(keys), "left").join(stock_grp, list(keys), "left")
    j = j.withColumn("target_max", F.coalesce("target_max", F.lit(0.0))).withColumn(
        "current_stock", F.coalesce("current_stock", F.lit(0)).cast("bigint")
    )
    tm, st = F.col("target_max"), F.col("current_stock")
    return j.select(
        *keys, "forecast_sma", "forecast_wag", "forecast_est", "forecast_avg", "target_max", "current_stock",
        order_formula(tm, F.col("forecast_sma"), st).alias("order_sma"),
        order_formula(tm, F.col("forecast_wag"), st).alias("order_wag"),
        order_formula(tm, F.col("forecast_est"), st).alias("order_est"),
        order_formula(tm, F.col("forecast_avg"), st).alias("order_avg"),
    )


def order_qty(plan: DataFrame, keys: Sequence[str] = PLAN_KEYS) -> DataFrame:
    """SMA and WAG orders: ``(TargetMax * Forecast + Forecast) - CurrentStock``."""
    return plan.select(*keys, "forecast_sma", "forecast_wag", "target_max", "current_stock", "order_sma", "order_wag")


def yoy_orders(plan: DataFrame, keys: Sequence[str] = PLAN_KEYS) -> DataFrame:
    """Orders for the same month next year: by the growth estimate and by the multi-year average."""
    return plan.select(*keys, "forecast_est", "forecast_avg", "target_max", "current_stock", "order_est", "order_avg")


def safety_factor(order: Column, factor_pct: float) -> Column:
    """Add a risk percentage to a recommended order."""
    return F.round(order * (1 + F.lit(factor_pct) / 100.0), 6)


def calculate_reorder(plan: DataFrame, keys: Sequence[str] = PLAN_KEYS) -> DataFrame:
    """Long form: one row per (key, method) with its forecast and order (``stack``, no join)."""
    return plan.select(
        *keys,
        F.expr(
            "stack(4, 'SMA', forecast_sma, order_sma, 'WAG', forecast_wag, order_wag, "
            "'YOY_EST', forecast_est, order_est, 'YOY_AVG', forecast_avg, order_avg) as (method, forecast, order_qty)"
        ),
    )


def recommend_purchase(reorder: DataFrame, method: str, factor_pct: float, k: int) -> DataFrame:
    """Positive orders of ``method`` with the safety factor, top ``k`` per shop.

    ``row_number() <= k`` lets Spark insert a per-partition group limit before
    the shuffle, so only ``k`` rows per shop and task move.
    """
    r = reorder.where((F.col("method") == method) & (F.col("order_qty") > 0))
    r = r.withColumn("recommended_qty", F.ceil(safety_factor(F.col("order_qty"), factor_pct)).cast("bigint"))
    w = Window.partitionBy("shop_id").orderBy(F.col("recommended_qty").desc(), F.col("group_id"))
    return r.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)


def purchase_proposal(recs: DataFrame, as_of: str) -> DataFrame:
    """One proposal per shop (status 'proposed'); lines ordered by rank (at most k per shop)."""
    day = dt.date.fromisoformat(as_of).strftime("%Y%m%d")
    g = recs.groupBy("shop_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "group_id", "recommended_qty"))).alias("lines"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("recommended_qty").alias("total_qty"),
    )
    return g.select(
        F.concat(F.lit("P-"), F.lit(day), F.lit("-"), F.col("shop_id").cast("string")).alias("proposal_id"),
        "shop_id", "lines", "n_lines", "total_qty", F.lit("proposed").alias("status"),
    )


def append_proposals(proposals: DataFrame, path: str) -> None:
    """Append proposals for approval (the approval workflow itself is out of scope)."""
    proposals.write.mode("append").partitionBy("status").parquet(path)


def proposal_text(lines: Column) -> Column:
    """``group:qty;group:qty`` rendering of proposal lines (for reports)."""
    return F.array_join(
        F.transform(lines, lambda x: F.concat(x["group_id"].cast("string"), F.lit(":"), x["recommended_qty"].cast("string"))),
        ";",
    )


def stock_balance_view(stock: DataFrame, branches: DataFrame, products: DataFrame) -> DataFrame:
    """Current stock with branch and product attributes (size-checked broadcast dims)."""
    b = bounded_broadcast(branches.select(F.col("id").alias("_bid"), F.col("name").alias("shop_name")),
                          upper_bound=known_rows(branches))
    p = bounded_broadcast(products.select(F.col("id").alias("_pid"), "description", "group_id", "type_id"),
                          upper_bound=known_rows(products))
    out = stock.join(b, stock["shop_id"] == F.col("_bid"), "left").join(p, stock["product_id"] == F.col("_pid"), "left")
    return out.select("shop_id", "shop_name", "product_id", "description", "group_id", "type_id", "qty")


def stock_vs_target(stock_grp: DataFrame, targets: DataFrame) -> DataFrame:
    t = _target_cols(targets)
    return stock_grp.join(t, ["shop_id", "group_id"], "inner")


def low_stock(stock_grp: DataFrame, targets: DataFrame) -> DataFrame:
    """(shop, group) whose stock is below the target minimum; ``gap`` = missing quantity."""
    j = stock_vs_target(stock_grp, targets).where(F.col("current_stock") < F.col("min_qty"))
    return j.select("shop_id", "group_id", "current_stock", "min_qty", "max_qty",
                    F.round(F.col("min_qty") - F.col("current_stock"), 6).alias("gap"))


def overstock(stock_grp: DataFrame, targets: DataFrame) -> DataFrame:
    """(shop, group) whose stock is above the target maximum; ``excess`` over it."""
    j = stock_vs_target(stock_grp, targets).where(F.col("current_stock") > F.col("max_qty"))
    return j.select("shop_id", "group_id", "current_stock", "min_qty", "max_qty",
                    F.round(F.col("current_stock") - F.col("max_qty"), 6).alias("excess"))


def true_sell_windows(detail: DataFrame, as_of: str, days: Sequence[int] = (7, 30)) -> DataFrame:
    """Sold quantity per (shop, product) over the last N days ending on ``as_of`` (inclusive), one pass."""
    end = dt.date.fromisoformat(as_of) + dt.timedelta(days=1)
    lo = {n: dt.date.fromisoformat(as_of) - dt.timedelta(days=n - 1) for n in days}
    widest = min(lo.values())
    d = detail.where(
        (F.col("sell_date") >= ts_lit(f"{widest} 00:00:00")) & (F.col("sell_date") < ts_lit(f"{end} 00:00:00"))
    )
    aggs = [
        F.sum(F.when(F.col("sell_date") >= ts_lit(f"{lo[n]} 00:00:00"), F.col("qty")).otherwise(0))
        .cast("double").alias(f"truesell_qty_{n}_day")
        for n in days
    ]
    return d.where(F.col("shop_id").isNotNull() & F.col("product_id").isNotNull()).groupBy("shop_id", "product_id").agg(*aggs)


def target_cover(stock: DataFrame, sold: DataFrame, products: DataFrame, targets: DataFrame,
                 by_type_bound: int | None = None) -> DataFrame:
    """Planning columns of the stock balance for every (shop, product) in stock.

    target_N_original = sold_N * sell_multiply + show_qty;
    target_N = target_N_original bounded to [min_qty, max_qty] of the (shop, group) setting;
    by-type columns sum stock and targets over (shop, product type).
    A product without a setting gets zero targets. ``by_type_bound`` is a proven
    bound on the (shop, type) pairs (|branches| x |types|); with it the by-type
    totals are broadcast back, without it they are joined by a shuffle.
    """
    p = bounded_broadcast(products.select(F.col("id").alias("product_id"), "group_id", "type_id"),
                          upper_bound=known_rows(products))
    t = bounded_broadcast(_target_cols(targets), upper_bound=known_rows(targets))
    base = stock.select("shop_id", "product_id", "qty").join(p, "product_id", "left")
    base = base.join(sold, ["shop_id", "product_id"], "left").join(t, ["shop_id", "group_id"], "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    cols = {}
    for n in (7, 30):
        orig = z(f"truesell_qty_{n}_day") * z("sell_multiply") + z("show_qty")
        cols[f"target_qty_{n}_day_original"] = F.round(orig, 6)
        cols[f"target_qty_{n}_day"] = F.round(F.least(F.greatest(orig, z("min_qty")), z("max_qty")), 6)
    base = base.select(
        "shop_id", "product_id", "group_id", "type_id", "qty",
        F.col("qty").cast("double").alias("current_qty"),
        z("truesell_qty_7_day").alias("truesell_qty_7_day"),
        z("truesell_qty_30_day").alias("truesell_qty_30_day"),
        z("min_qty").alias("min_qty"), z("max_qty").alias("max_qty"),
        *[c.alias(n) for n, c in cols.items()],
    )
    by_type = base.groupBy("shop_id", "type_id").agg(
        F.sum("current_qty").alias("current_qty_by_type"),
        F.round(F.sum("target_qty_7_day"), 6).alias("target_qty_by_type_7_day"),
        F.round(F.sum("target_qty_30_day"), 6).alias("target_qty_by_type_30_day"),
    )
    if by_type_bound is not None:
        by_type = bounded_broadcast(by_type, upper_bound=by_type_bound)
    by_type = by_type.withColumnsRenamed({"shop_id": "_shop", "type_id": "_type"})
    same = (F.col("shop_id") == F.col("_shop")) & F.col("type_id").eqNullSafe(F.col("_type"))  # an unknown type is a type of its own
    return base.join(by_type, same, "left").drop("group_id", "type_id", "_shop", "_type")


def rebalance_stock(
    stock: DataFrame,
    sold: DataFrame,
    need_col: str = "truesell_qty_30_day",
    product_col: str = "product_id",
) -> DataFrame:
    """Transfers of surplus stock to branches short of their need, per product.

    Surplus = max(stock - need, 0), deficit = max(need - stock, 0). Surplus and
    deficit branches are each laid end to end on a line (ordered by shop id,
    cumulative sums); a transfer is the overlap of a surplus interval with a
    deficit interval. Overlaps are found by sweeping the interval start points
    per product in order (``last(..., ignorenulls)`` carries the current
    surplus and deficit branch), not by pairing every surplus branch with every
    deficit branch. One shuffle by product feeds both window passes; a
    product's rows are bounded by the number of branches.
    """
    j = stock.select("shop_id", product_col, "qty").join(
        sold.select("shop_id", product_col, need_col), ["shop_id", product_col], "full"
    )
    stock_v = F.coalesce(F.col("qty").cast("double"), F.lit(0.0))
    need_v = F.coalesce(F.col(need_col), F.lit(0.0))
    j = j.select(
        "shop_id", product_col,
        F.greatest(stock_v - need_v, F.lit(0.0)).alias("surplus"),
        F.greatest(need_v - stock_v, F.lit(0.0)).alias("deficit"),
    ).where((F.col("surplus") > 0) | (F.col("deficit") > 0))
    by_shop = Window.partitionBy(product_col).orderBy("shop_id")
    run = by_shop.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(product_col)
    j = j.select(
        product_col, "shop_id", "surplus", "deficit",
        (F.sum("surplus").over(run) - F.col("surplus")).alias("s_pos"),
        (F.sum("deficit").over(run) - F.col("deficit")).alias("d_pos"),
        F.least(F.sum("surplus").over(whole), F.sum("deficit").over(whole)).alias("limit"),
    )
    # Each branch starts one interval (kind 0 = surplus, 1 = deficit) at its cumulative position.
    pts = j.select(
        product_col, "limit",
        F.explode(F.array(
            F.when(F.col("surplus") > 0, F.struct(F.col("s_pos").alias("pos"), F.lit(0).alias("kind"),
                                                  F.col("shop_id").alias("shop"))),
            F.when(F.col("deficit") > 0, F.struct(F.col("d_pos").alias("pos"), F.lit(1).alias("kind"),
                                                  F.col("shop_id").alias("shop"))),
        )).alias("p"),
    ).where(F.col("p").isNotNull()).select(product_col, "limit", "p.pos", "p.kind", "p.shop")
    order = Window.partitionBy(product_col).orderBy("pos", "kind")
    sweep = order.rowsBetween(Window.unboundedPreceding, 0)
    pts = pts.select(
        product_col, "pos", "limit",
        F.last(F.when(F.col("kind") == 0, F.col("shop")), ignorenulls=True).over(sweep).alias("from_shop"),
        F.last(F.when(F.col("kind") == 1, F.col("shop")), ignorenulls=True).over(sweep).alias("to_shop"),
        F.lead("pos").over(order).alias("next_pos"),
    )
    seg = F.least(F.coalesce(F.col("next_pos"), F.col("limit")), F.col("limit")) - F.col("pos")
    pts = pts.where(F.col("from_shop").isNotNull() & F.col("to_shop").isNotNull() & (seg > 0))
    return pts.groupBy(product_col, "from_shop", "to_shop").agg(F.round(F.sum(seg), 6).alias("transfer_qty"))
