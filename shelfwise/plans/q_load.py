"""Registered queries: scans, cleansing loads, filters, joins, aggregates, upserts."""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.dates import clamp_probe_days, closed_range, lookback
from ..functions.expr import default_if_empty, flag_to_bool, positive
from ..operators import bucketed as BK
from ..operators import keys as K
from ..operators import summary as SM
from ..operators.upsert import conform, merge, upsert
from ..session import scratch_path, session_key
from ..sources.tables import read_fact_range
from ..sources.views import Domain
from . import loads as L
from . import params as P
from .catalog import register

TS_NOW = f"timestamp '{P.NOW}'"
TS_LATER = f"timestamp '{P.LATER}'"


_MEMO: dict = {}


def dom(spark: SparkSession, sf: str) -> Domain:
    key = ("dom", session_key(spark), sf)
    if key not in _MEMO:
        _MEMO[key] = Domain(spark, sf)
    return _MEMO[key]


def full(spark: SparkSession, sf: str, now: str = P.NOW) -> L.Targets:
    """The fresh whole-range load (lazy plans, built once per session and data dir)."""
    key = ("full", session_key(spark), sf, now)
    if key not in _MEMO:
        ensure_scratch(spark)
        _MEMO[key] = L.build_targets(dom(spark, sf), P.FULL_START, P.FULL_END, now, materialize=True)
    return _MEMO[key]


_LOCK = threading.Lock()


@dataclass(frozen=True)
class Stored:
    """Targets written by a whole ``run_full``, and the monthly summary kept from them."""

    root: str
    summary: str
    first_month: str | None
    counts: dict


def stored(spark: SparkSession, sf: str) -> Stored:
    """The written targets and summary of a data directory (loaded once per session)."""
    key = ("stored", session_key(spark), sf)
    with _LOCK:
        if key not in _MEMO:
            ensure_scratch(spark)
            root = scratch_path(spark, "stored")
            counts = L.run_full(spark, dom(spark, sf), root, P.AS_OF, now=P.NOW)["counts"]
            SM.refresh(spark, f"{root}/sell_detail", f"{root}/monthly")
            _MEMO[key] = Stored(root, f"{root}/monthly", SM.first_month(spark, f"{root}/monthly"), counts)
        return _MEMO[key]


def ranged(spark: SparkSession, sf: str) -> str:
    """The targets written by a ``run_load`` of RANGE_START to RANGE_END (once per session)."""
    key = ("ranged", session_key(spark), sf)
    with _LOCK:
        if key not in _MEMO:
            ensure_scratch(spark)
            root = scratch_path(spark, "ranged")
            L.run_load(spark, dom(spark, sf), root, "repair", P.AS_OF, P.RANGE_START, P.RANGE_END, now=P.NOW)
            _MEMO[key] = root
        return _MEMO[key]


def stored_fact(spark: SparkSession, sf: str, spec: S.TableSpec) -> DataFrame:
    """A month-partitioned target as it was written, with ``sell_month``."""
    return spark.read.parquet(f"{stored(spark, sf).root}/{spec.name}")


def ensure_scratch(spark: SparkSession) -> None:
    """Sessions without ``spark.checkpoint.dir`` (tests, the local check) get a fresh folder, once."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)


def active_shops(t: L.Targets) -> DataFrame:
    return t.branches.where("is_active")


def limited_products(t: L.Targets) -> DataFrame:
    return t.products.where(F.col("group_id") <= P.MAX_VALID_GROUP)


def rng(col: str, start: str | None, end: str | None) -> str:
    low = f"{col} >= timestamp '{start} 00:00:00'" if start else "true"
    return f"{low} and {col} <= timestamp '{end} 23:59:59'" if end else low


# Shared oracle CTEs for loaded targets.
T_BRANCHES = f"""
    select id, coalesce(code, '') as code, coalesce(name, '') as name,
           coalesce(active = 'Y', false) as is_active,
           {TS_NOW} as created_at, {TS_NOW} as updated_at
    from v_shop"""
T_ACTIVE = "select id from t_branches where is_active"
T_PRODUCTS = f"""
    select p.id, coalesce(p.pu_product_id, '') as pu_product_id,
           p.brand_id, p.category_id, p.group_id, p.type_id,
           coalesce(nullif(p.description, ''), 'Unspecified Product') as description,
           coalesce(nullif(p.status, ''), 'ACTIVE') as status,
           {TS_NOW} as created_at, {TS_NOW} as updated_at
    from v_product p"""
T_LIMITED = f"select id from t_products where group_id <= {P.MAX_VALID_GROUP}"
T_SUPPLIERS = f"""
    select id, coalesce(code, '') as code, coalesce(name, '') as name, coalesce(tax_id, '') as tax_id,
           coalesce(address, '') as address, coalesce(tel, '') as tel, coalesce(fax, '') as fax,
           coalesce(contact1, '') as contact_name, coalesce(email1, '') as email,
           'ACTIVE' as status, {TS_NOW} as created_at, {TS_NOW} as updated_at
    from v_company where type = 'S'"""
BASE_CTES = {
    "t_branches": T_BRANCHES,
    "t_active": T_ACTIVE,
    "t_products": T_PRODUCTS,
    "t_limited": T_LIMITED,
    "t_suppliers": T_SUPPLIERS,
}


# ---------------------------------------------------------------------------
# 2.1 scans
# ---------------------------------------------------------------------------
@register("scan_full", "select * from v_product")
def q_scan_full(spark, sf):
    return dom(spark, sf).v_product


@register(
    "scan_projected_range",
    f"select id, shop_id, sell_date from v_sell where {rng('sell_date', P.RANGE_START, P.RANGE_END)}",
)
def q_scan_projected_range(spark, sf):
    return dom(spark, sf).v_sell.select("id", "shop_id", "sell_date").where(
        closed_range("sell_date", P.RANGE_START, P.RANGE_END)
    )


@register("scan_filtered", "select * from v_company where type = 'S'")
def q_scan_filtered(spark, sf):
    return dom(spark, sf).v_company.where(F.col("type") == "S")


@register("scan_paged", "select shop_id, product_id, qty from v_stock_shop")
def q_scan_paged(spark, sf):
    # Split scan: every row exactly once, in parallel (no LIMIT/OFFSET pages).
    return dom(spark, sf).v_stock_shop


@register(
    "scan_join_pushed",
    "select d.id, d.sell_id, d.company_id, d.product_id, d.shop_id, d.qty, s.sell_date "
    "from v_sell_detail d join v_sell s on d.sell_id = s.id",
)
def q_scan_join_pushed(spark, sf):
    d = dom(spark, sf)
    return L.join_detail_header(d.v_sell_detail, d.v_sell, P.FULL_START, P.FULL_END)


@register("scan_keyset", "select distinct id as _k from v_product where id is not null")
def q_scan_keyset(spark, sf):
    return K.key_set(dom(spark, sf).v_product)


@register("scan_target_all", "select * from t_branches", BASE_CTES)
def q_scan_target_all(spark, sf):
    return full(spark, sf).branches


# ---------------------------------------------------------------------------
# 2.2 projections and filters
# ---------------------------------------------------------------------------
@register("load_branches", "select * from t_branches", BASE_CTES)
def q_load_branches(spark, sf):
    return conform(L.load_branches(dom(spark, sf).v_shop), S.BRANCHES, P.NOW)


def _named_sql(id_col: str, label_col: str, label: str, distinct_from: str = "v_product") -> str:
    return (
        f"select id, coalesce({label}, '') as {label}, 'ACTIVE' as status, {TS_NOW} as created_at "
        f"from (select distinct {id_col} as id, {label_col} as {label} from {distinct_from})"
    )


@register("load_brands", _named_sql("brand_id", "brand_name", "name"))
def q_load_brands(spark, sf):
    return full(spark, sf).brands


@register("load_categories", _named_sql("category_id", "category_name", "name"))
def q_load_categories(spark, sf):
    return full(spark, sf).categories


@register("load_groups", _named_sql("group_id", "'SIZE ' || cast(group_id as varchar)", "description"))
def q_load_groups(spark, sf):
    return full(spark, sf).groups


@register("load_types", _named_sql("type_id", "type_name", "name"))
def q_load_types(spark, sf):
    return full(spark, sf).types


@register("load_suppliers", "select * from t_suppliers", BASE_CTES)
def q_load_suppliers(spark, sf):
    return full(spark, sf).suppliers


CUSTOMERS_SQL = f"""select id, coalesce(code, '') as code, coalesce(name, '') as name, coalesce(tax_id, '') as tax_id,
       coalesce(nationid, '') as nation_id, coalesce(address, '') as address, coalesce(tel, '') as tel,
       coalesce(email1, '') as email, 'ACTIVE' as status, {TS_NOW} as created_at, {TS_NOW} as updated_at
       from v_company where type = 'C'"""


@register(
    "load_customers",
    CUSTOMERS_SQL,
)
def q_load_customers(spark, sf):
    return full(spark, sf).customers


@register(
    "load_products",
    f"""select p.id, p.pu_product_id, p.brand_id, p.category_id,
           case when p.group_id in (select id from t_limited_groups) then p.group_id end as group_id,
           p.type_id, p.description, p.status, p.created_at, p.updated_at
       from t_products p""",
    {**BASE_CTES, "t_limited_groups": f"select distinct group_id as id from v_product where group_id <= {P.MAX_VALID_GROUP}"},
)
def q_load_products(spark, sf):
    t = full(spark, sf)
    groups = t.groups.where(F.col("id") <= P.MAX_VALID_GROUP)
    d = dom(spark, sf)
    return conform(L.load_products(d.v_product, t.brands, t.categories, groups, t.types), S.PRODUCTS, P.NOW)


@register(
    "default_if_empty",
    "select id, coalesce(nullif(description, ''), 'Unspecified Product') as description, "
    "coalesce(nullif(status, ''), 'ACTIVE') as status from v_product",
)
def q_default_if_empty(spark, sf):
    p = dom(spark, sf).v_product
    return p.select(
        "id",
        default_if_empty("description", S.UNSPECIFIED_PRODUCT).alias("description"),
        default_if_empty("status", S.STATUS_ACTIVE).alias("status"),
    )


@register("flag_to_bool", "select id, coalesce(active = 'Y', false) as is_active from v_shop")
def q_flag_to_bool(spark, sf):
    return dom(spark, sf).v_shop.select("id", flag_to_bool("active").alias("is_active"))


@register(
    "filter_positive_key",
    "select shop_id, product_id, qty from v_stock_shop where shop_id > 0 and product_id > 0",
)
def q_filter_positive_key(spark, sf):
    return dom(spark, sf).v_stock_shop.where(positive("shop_id", "product_id"))


@register(
    "filter_active_count",
    "select 'shop' as entity, id from v_shop where active = 'Y' "
    "union all select 'product', id from t_products where status = 'ACTIVE'",
    BASE_CTES,
)
def q_filter_active_count(spark, sf):
    d = dom(spark, sf)
    shops = d.v_shop.where(F.col("active") == "Y").select(F.lit("shop").alias("entity"), "id")
    prods = full(spark, sf).products.where(F.col("status") == S.STATUS_ACTIVE)
    return shops.unionByName(prods.select(F.lit("product").alias("entity"), "id"))


@register("filter_date_closed", f"select * from v_sell where {rng('sell_date', P.RANGE_START, P.RANGE_END)}")
def q_filter_date_closed(spark, sf):
    return dom(spark, sf).v_sell.where(closed_range("sell_date", P.RANGE_START, P.RANGE_END))


def _lookback_start() -> str:
    import datetime as dt

    return (dt.date.fromisoformat(P.AS_OF) - dt.timedelta(days=clamp_probe_days(30))).isoformat()


@register("filter_lookback", f"select * from v_sell where sell_date >= timestamp '{_lookback_start()} 00:00:00'")
def q_filter_lookback(spark, sf):
    # A requested 30-day probe is clamped to the 7-day safety window.
    return dom(spark, sf).v_sell.where(lookback("sell_date", P.AS_OF, clamp_probe_days(30)))


T_SELL = f"""
    select s.id, case when s.shop_id in (select id from t_branches) then s.shop_id end as shop_id,
           s.sell_date, {TS_NOW} as created_at
    from v_sell s where {rng('s.sell_date', P.FULL_START, P.FULL_END)}"""
T_DETAIL = f"""
    select d.id, d.sell_id,
           case when d.company_id in (select id from t_suppliers) then d.company_id end as company_id,
           case when d.product_id in (select id from t_products) then d.product_id end as product_id,
           case when d.shop_id in (select id from t_branches) then d.shop_id end as shop_id,
           coalesce(d.qty, 0) as qty, s.sell_date, {TS_NOW} as created_at
    from v_sell_detail d join v_sell s on d.sell_id = s.id
    where {rng('s.sell_date', P.FULL_START, P.FULL_END)}"""
FACT_CTES = {**BASE_CTES, "t_sell": T_SELL, "t_detail": T_DETAIL}


@register(
    "get_sells_by_range",
    f"select * from t_sell where {rng('sell_date', P.RANGE_START, P.RANGE_END)}",
    FACT_CTES,
)
def q_get_sells_by_range(spark, sf):
    return read_fact_range(spark, f"{stored(spark, sf).root}/sell", P.RANGE_START, P.RANGE_END).select(*S.SELL.columns)


@register(
    "get_details_by_sell",
    f"select * from t_detail where sell_id in (select id from t_sell where {rng('sell_date', P.RANGE_START, P.RANGE_END)})",
    FACT_CTES,
)
def q_get_details_by_sell(spark, sf):
    # Batch form of "details of a bill": details of every bill a caller holds.
    # A bill and its details carry the same date, so the bills' months prune the stored details.
    bills = read_fact_range(spark, f"{stored(spark, sf).root}/sell", P.RANGE_START, P.RANGE_END)
    details = read_fact_range(spark, f"{stored(spark, sf).root}/sell_detail", P.RANGE_START, P.RANGE_END)
    bills = bills.select(F.col("id").alias("_sid"))
    return details.join(bills, F.col("sell_id") == F.col("_sid"), "left_semi").select(*S.SELL_DETAIL.columns)


T_STOCK = """
    select shop_id, product_id, cast(sum(coalesce(qty, 0)) as bigint) as qty
    from v_stock_shop
    where shop_id > 0 and product_id > 0
      and shop_id in (select id from t_branches) and product_id in (select id from t_products)
    group by shop_id, product_id"""
STOCK_COLS = ", ".join(
    ["shop_id", "product_id", "cast(null as varchar) as pu_product_id", "cast(qty as integer) as qty"]
    + [f"cast(0 as double) as {m}" for m in S.STOCK_METRICS]
    + [f"'{S.PO_STATUS_DEFAULT}' as po_status", f"{TS_NOW} as created_at", f"{TS_NOW} as updated_at"]
)
T_SETTING_LATEST = """
    select shop_id, product_group_id, setting_id, '' as pu_product_id, min_qty, max_qty, sell_multiply, show_qty, category_id,
           type_id, brand_id, created_by, updated_by, created_at, updated_at
    from (
        select *, id as setting_id,
               row_number() over (partition by shop_id, product_group_id order by id desc) as rn
        from v_setting
        where shop_id > 0 and product_group_id > 0 and shop_id in (select id from t_branches)
    ) where rn = 1"""
STOCK_CTES = {**BASE_CTES, "t_stock": T_STOCK, "t_setting_latest": T_SETTING_LATEST}


@register(
    "get_stock_by_shop",
    f"select {STOCK_COLS} from t_stock where shop_id in (select id from t_active)",
    STOCK_CTES,
)
def q_get_stock_by_shop(spark, sf):
    t = full(spark, sf)
    shops = active_shops(t).select(F.col("id").alias("_s"))
    return t.stock_balance.join(shops, F.col("shop_id") == F.col("_s"), "left_semi")


T_TARGET_COLS = """shop_id, product_group_id, category_id, type_id, brand_id, pu_product_id,
    min_qty, max_qty, sell_multiply, show_qty, created_by, updated_by, created_at, updated_at"""


@register(
    "get_targets_by_shop",
    f"select {T_TARGET_COLS} from t_setting_latest where shop_id in (select id from t_active)",
    STOCK_CTES,
)
def q_get_targets_by_shop(spark, sf):
    t = full(spark, sf)
    shops = active_shops(t).select(F.col("id").alias("_s"))
    return t.stock_targets.join(shops, F.col("shop_id") == F.col("_s"), "left_semi")


@register(
    "key_lookup",
    """select k.id, p.pu_product_id, p.brand_id, p.category_id, p.group_id, p.type_id, p.description,
              p.status, p.created_at, p.updated_at, p.id is not null as found
       from (select distinct product_id as id from v_sell_detail) k
       left join (select * from t_products where group_id <= 40) p on k.id = p.id""",
    BASE_CTES,
)
def q_key_lookup(spark, sf):
    t = full(spark, sf)
    keys = dom(spark, sf).v_sell_detail.select(F.col("product_id").alias("id")).distinct()
    return K.key_lookup(keys, limited_products(t))


# ---------------------------------------------------------------------------
# 2.3 joins
# ---------------------------------------------------------------------------
@register(
    "join_detail_header",
    "select d.id, d.sell_id, d.company_id, d.product_id, d.shop_id, d.qty, s.sell_date "
    f"from v_sell_detail d join v_sell s on d.sell_id = s.id where {rng('s.sell_date', P.RANGE_START, P.RANGE_END)}",
)
def q_join_detail_header(spark, sf):
    d = dom(spark, sf)
    return L.join_detail_header(d.v_sell_detail, d.v_sell, P.RANGE_START, P.RANGE_END)


@register(
    "fk_nullify",
    "select s.id, case when s.shop_id in (select id from t_active) then s.shop_id end as shop_id, s.sell_date "
    "from v_sell s",
    BASE_CTES,
)
def q_fk_nullify(spark, sf):
    t = full(spark, sf)
    return K.fk_nullify(dom(spark, sf).v_sell, {"shop_id": active_shops(t)})


@register(
    "fk_semi_filter",
    "select * from v_stock_shop where shop_id > 0 and product_id > 0 "
    "and shop_id in (select id from t_active) and product_id in (select id from t_limited)",
    BASE_CTES,
)
def q_fk_semi_filter(spark, sf):
    t = full(spark, sf)
    return K.fk_semi_filter(
        dom(spark, sf).v_stock_shop, {"shop_id": active_shops(t), "product_id": limited_products(t)}
    )


@register(
    "fk_reject",
    """select * from (
         select shop_id, product_id, qty,
                nullif(concat_ws(',',
                   case when not (shop_id > 0 and shop_id in (select id from t_active)) or shop_id is null
                        then 'unknown_shop_id' end,
                   case when not (product_id > 0 and product_id in (select id from t_limited)) or product_id is null
                        then 'unknown_product_id' end), '') as fk_reason
         from v_stock_shop) where fk_reason is not null""",
    BASE_CTES,
)
def q_fk_reject(spark, sf):
    t = full(spark, sf)
    return K.fk_reject(
        dom(spark, sf).v_stock_shop, {"shop_id": active_shops(t), "product_id": limited_products(t)}
    )


# ---------------------------------------------------------------------------
# 2.4 aggregates
# ---------------------------------------------------------------------------
@register("load_stock_balance", "select * from t_stock", STOCK_CTES)
def q_load_stock_balance(spark, sf):
    t = full(spark, sf)
    return L.load_stock_balance(dom(spark, sf).v_stock_shop, t.branches, t.products)


@register("load_stock_targets", "select * from t_setting_latest", STOCK_CTES)
def q_load_stock_targets(spark, sf):
    t = full(spark, sf)
    return L.load_stock_targets(dom(spark, sf).v_setting, t.branches)


@register(
    "count_probe",
    f"""select 'active_shops' as probe, count(*) as n from v_shop where active = 'Y'
        union all select 'active_products', count(*) from t_products where status = 'ACTIVE'
        union all select 'recent_sales', count(*) from v_sell
                  where sell_date >= timestamp '{_lookback_start()} 00:00:00'""",
    BASE_CTES,
)
def q_count_probe(spark, sf):
    from ..operators.aggregates import count_probe

    d = dom(spark, sf)
    return count_probe(d.v_shop, full(spark, sf).products, d.v_sell, P.AS_OF, 30)


@register(
    "count_loaded",
    """select 'branches' as table_name, count(*) as n_rows from t_branches
       union all select 'suppliers', count(*) from t_suppliers
       union all select 'products', count(*) from t_products
       union all select 'stock_balance', count(*) from t_stock
       union all select 'stock_targets', count(*) from t_setting_latest
       union all select 'sell', count(*) from t_sell
       union all select 'sell_detail', count(*) from t_detail""",
    {**STOCK_CTES, **FACT_CTES},
)
def q_count_loaded(spark, sf):
    counts = stored(spark, sf).counts  # observed while the targets were written
    names = ("branches", "suppliers", "products", "stock_balance", "stock_targets", "sell", "sell_detail")
    return spark.createDataFrame([(n, counts[n]) for n in names], "table_name string, n_rows long")


# ---------------------------------------------------------------------------
# 2.5 upserts: target = earlier load (NOW), batch = overlapping later load (LATER)
# ---------------------------------------------------------------------------
def _rerun_sql(table_cte: str, cols: list[str], updates: list[str], key: list[str]) -> str:
    """Oracle of re-loading an unchanged source later: updates listed columns, keeps created_at."""
    out = []
    for c in cols:
        if c == "updated_at" and c in updates:
            out.append(f"{TS_LATER} as updated_at")
        else:
            out.append(c)
    return f"select {', '.join(out)} from {table_cte}"


@register(
    "upsert_branches",
    _rerun_sql("t_branches", S.BRANCHES.columns, list(S.BRANCHES.updates), ["id"]),
    BASE_CTES,
)
def q_upsert_branches(spark, sf):
    d = dom(spark, sf)
    old = conform(L.load_branches(d.v_shop), S.BRANCHES, P.NOW)
    return upsert(old, L.load_branches(d.v_shop), S.BRANCHES, P.LATER)


def _earlier_sql(id_col: str, label_col: str, label: str) -> str:
    """Oracle: the batch renames every row and adds a third; a row of the target that it lacks stays."""
    return (
        f"select id, coalesce({label}, '') as {label}, 'ACTIVE' as status, "
        f"case when id % 3 <> 0 then {TS_NOW} else {TS_LATER} end as created_at "
        f"from (select distinct {id_col} as id, {label_col} as {label} from v_product) "
        f"union all select -1, 'gone', 'CLOSED', {TS_NOW}"
    )


def _upsert_named(source: DataFrame, spec: S.TableSpec, label: str) -> DataFrame:
    """The target holds two thirds of the rows under other names, and one that is gone from the source."""
    batch = L.load_named_master(source, label)
    earlier = batch.where(F.col("id") % 3 != 0).select("id", F.concat(F.lit("old "), label).alias(label), F.lit("CLOSED").alias("status"))
    gone = earlier.sparkSession.createDataFrame([(-1, "gone", "CLOSED")], earlier.schema)
    return upsert(conform(earlier.unionByName(gone), spec, P.NOW), batch, spec, P.LATER)


@register("upsert_brands", _earlier_sql("brand_id", "brand_name", "name"))
def q_upsert_brands(spark, sf):
    return _upsert_named(L.brands_source(dom(spark, sf).v_product), S.BRANDS, "name")


@register("upsert_categories", _earlier_sql("category_id", "category_name", "name"))
def q_upsert_categories(spark, sf):
    return _upsert_named(L.categories_source(dom(spark, sf).v_product), S.CATEGORIES, "name")


@register("upsert_groups", _earlier_sql("group_id", "'SIZE ' || cast(group_id as varchar)", "description"))
def q_upsert_groups(spark, sf):
    return _upsert_named(L.groups_source(dom(spark, sf).v_product), S.GROUPS, "description")


@register("upsert_types", _earlier_sql("type_id", "type_name", "name"))
def q_upsert_types(spark, sf):
    return _upsert_named(L.types_source(dom(spark, sf).v_product), S.TYPES, "name")


@register(
    "upsert_suppliers",
    _rerun_sql("t_suppliers", S.SUPPLIERS.columns, list(S.SUPPLIERS.updates), ["id"]),
    BASE_CTES,
)
def q_upsert_suppliers(spark, sf):
    d = dom(spark, sf)
    old = conform(L.load_suppliers(d.v_company), S.SUPPLIERS, P.NOW)
    return upsert(old, L.load_suppliers(d.v_company), S.SUPPLIERS, P.LATER)


@register(
    "upsert_customers",
    f"""select id, coalesce(code, '') as code, coalesce(name, '') as name, coalesce(tax_id, '') as tax_id,
           coalesce(nationid, '') as nation_id, coalesce(address, '') as address, coalesce(tel, '') as tel,
           coalesce(email1, '') as email, 'ACTIVE' as status, {TS_NOW} as created_at, {TS_LATER} as updated_at
       from v_company where type = 'C'""",
)
def q_upsert_customers(spark, sf):
    d = dom(spark, sf)
    old = conform(L.load_customers(d.v_company), S.CUSTOMERS, P.NOW)
    return upsert(old, L.load_customers(d.v_company), S.CUSTOMERS, P.LATER)


@register(
    "upsert_products",
    f"""select id, pu_product_id, brand_id, category_id, group_id, type_id, description, status,
              created_at, {TS_LATER} as updated_at
       from t_products""",
    BASE_CTES,
)
def q_upsert_products(spark, sf):
    # Target loaded while groups > 40 were unknown (group_id NULL); the later batch repairs them.
    t = full(spark, sf)
    d = dom(spark, sf)
    old_groups = t.groups.where(F.col("id") <= P.MAX_VALID_GROUP)
    old = conform(L.load_products(d.v_product, t.brands, t.categories, old_groups, t.types), S.PRODUCTS, P.NOW)
    batch = L.load_products(d.v_product, t.brands, t.categories, t.groups, t.types)
    return upsert(old, batch, S.PRODUCTS, P.LATER)


# Facts: old = load of [FULL_START, OLD_END] with all shops; batch = [NEW_START, FULL_END] with active shops.
SELL_OLD = f"""
    select s.id, s.shop_id, s.sell_date, {TS_NOW} as created_at
    from v_sell s where {rng('s.sell_date', P.FULL_START, P.OLD_END)}"""
SELL_NEW = f"""
    select s.id, case when s.shop_id in (select id from t_active) then s.shop_id end as shop_id,
           s.sell_date, {TS_LATER} as created_at
    from v_sell s where {rng('s.sell_date', P.NEW_START, P.FULL_END)}"""
UPSERT_SELL_SQL = """
    select n.id, n.shop_id, n.sell_date, coalesce(o.created_at, n.created_at) as created_at
    from sell_new n left join sell_old o on n.id = o.id and n.sell_date = o.sell_date
    union all
    select o.* from sell_old o
    where not exists (select 1 from sell_new n where n.id = o.id and n.sell_date = o.sell_date)"""


def _sell_pair(spark, sf):
    d = dom(spark, sf)
    t = full(spark, sf)
    old = conform(L.load_sell(d.v_sell, P.FULL_START, P.OLD_END, t.branches), S.SELL, P.NOW)
    batch = L.load_sell(d.v_sell, P.NEW_START, P.FULL_END, active_shops(t))
    return old, batch


def _upserted(spark, spec: S.TableSpec, old: DataFrame, batch: DataFrame) -> DataFrame:
    """Two loads into a bucketed fact, the later one over the months it touches."""
    root = scratch_path(spark, "queries", spec.name)
    BK.upsert_fact(spark, root, old, spec, P.NOW, buckets=2)
    BK.upsert_fact(spark, root, batch, spec, P.LATER)
    return BK.read_fact(spark, root, spec).select(*spec.columns)


@register("upsert_sells", UPSERT_SELL_SQL, {**BASE_CTES, "sell_old": SELL_OLD, "sell_new": SELL_NEW})
def q_upsert_sells(spark, sf):
    return _upserted(spark, S.SELL, *_sell_pair(spark, sf))


@register(
    "upsert_generic",
    """select n.id, n.shop_id, n.sell_date from sell_new n
       union all
       select o.id, o.shop_id, o.sell_date from sell_old o
       where not exists (select 1 from sell_new n where n.id = o.id and n.sell_date = o.sell_date)""",
    {**BASE_CTES, "sell_old": SELL_OLD, "sell_new": SELL_NEW},
)
def q_upsert_generic(spark, sf):
    old, batch = _sell_pair(spark, sf)
    return merge(old.select("id", "shop_id", "sell_date"), batch, ["id", "sell_date"], ["shop_id"])


DETAIL_OLD = f"""
    select d.id, d.sell_id, d.company_id, d.product_id, d.shop_id, coalesce(d.qty, 0) as qty, s.sell_date,
           {TS_NOW} as created_at
    from v_sell_detail d join v_sell s on d.sell_id = s.id
    where {rng('s.sell_date', P.FULL_START, P.OLD_END)}"""
DETAIL_NEW = f"""
    select d.id, d.sell_id, d.company_id,
           case when d.product_id in (select id from t_limited) then d.product_id end as product_id,
           case when d.shop_id in (select id from t_active) then d.shop_id end as shop_id,
           coalesce(d.qty, 0) as qty, s.sell_date, {TS_LATER} as created_at
    from v_sell_detail d join v_sell s on d.sell_id = s.id
    where {rng('s.sell_date', P.NEW_START, P.FULL_END)}"""


@register(
    "upsert_sell_details",
    """select n.id, n.sell_id, n.company_id, n.product_id, n.shop_id, n.qty, n.sell_date,
              coalesce(o.created_at, n.created_at) as created_at
       from detail_new n left join detail_old o on n.id = o.id and n.sell_date = o.sell_date
       union all
       select o.* from detail_old o
       where not exists (select 1 from detail_new n where n.id = o.id and n.sell_date = o.sell_date)""",
    {**BASE_CTES, "detail_old": DETAIL_OLD, "detail_new": DETAIL_NEW},
)
def q_upsert_sell_details(spark, sf):
    d = dom(spark, sf)
    t = full(spark, sf)
    old = conform(
        L.load_sell_detail(d.v_sell_detail, d.v_sell, P.FULL_START, P.OLD_END, t.branches, t.products, t.suppliers),
        S.SELL_DETAIL, P.NOW,
    )
    batch = L.load_sell_detail(
        d.v_sell_detail, d.v_sell, P.NEW_START, P.FULL_END, active_shops(t), limited_products(t), t.suppliers
    )
    return _upserted(spark, S.SELL_DETAIL, old, batch)


@register(
    "upsert_stock_balance",
    f"""select {STOCK_COLS.replace(f'{TS_NOW} as updated_at', 'case when in_new then ' + TS_LATER + ' else ' + TS_NOW + ' end as updated_at')}
       from (select s.*, (s.shop_id in (select id from t_active)
                          and s.product_id in (select id from t_limited)) as in_new
             from t_stock s)""",
    STOCK_CTES,
)
def q_upsert_stock_balance(spark, sf):
    # Later batch validated against fewer keys: its keys are updated, the rest stay (no deletes).
    t = full(spark, sf)
    d = dom(spark, sf)
    batch = L.load_stock_balance(d.v_stock_shop, active_shops(t), limited_products(t))
    return upsert(t.stock_balance, batch, S.STOCK_BALANCE, P.LATER)


SETTING_CUTOFF = "2024-01-20 00:00:00"


@register(
    "upsert_stock_targets",
    f"""select coalesce(n.shop_id, o.shop_id) as shop_id,
              coalesce(n.product_group_id, o.product_group_id) as product_group_id,
              case when n.shop_id is not null then n.category_id else o.category_id end as category_id,
              case when n.shop_id is not null then n.type_id else o.type_id end as type_id,
              case when n.shop_id is not null then n.brand_id else o.brand_id end as brand_id,
              '' as pu_product_id,
              case when n.shop_id is not null then n.min_qty else o.min_qty end as min_qty,
              case when n.shop_id is not null then n.max_qty else o.max_qty end as max_qty,
              case when n.shop_id is not null then n.sell_multiply else o.sell_multiply end as sell_multiply,
              case when n.shop_id is not null then n.show_qty else o.show_qty end as show_qty,
              case when n.shop_id is not null then n.created_by else o.created_by end as created_by,
              case when n.shop_id is not null then n.updated_by else o.updated_by end as updated_by,
              case when o.shop_id is not null then o.created_at else n.created_at end as created_at,
              case when n.shop_id is not null then n.updated_at else o.updated_at end as updated_at
       from (select * from t_setting_latest_old) o
       full join (select * from t_setting_latest) n
         on o.shop_id = n.shop_id and o.product_group_id = n.product_group_id""",
    {
        **STOCK_CTES,
        "t_setting_latest_old": T_SETTING_LATEST.replace(
            "from v_setting", f"from v_setting where created_at < timestamp '{SETTING_CUTOFF}'"
        ).replace("        where shop_id > 0", "          and shop_id > 0"),
    },
)
def q_upsert_stock_targets(spark, sf):
    t = full(spark, sf)
    d = dom(spark, sf)
    old_src = d.v_setting.where(F.col("created_at") < F.lit(SETTING_CUTOFF).cast("timestamp_ntz"))
    old = conform(L.load_stock_targets(old_src, t.branches), S.STOCK_TARGETS, P.NOW)
    batch = L.load_stock_targets(d.v_setting, t.branches)
    return upsert(old, batch, S.STOCK_TARGETS, P.LATER)


@register(
    "load_sell",
    f"""select s.id, case when s.shop_id in (select id from t_active) then s.shop_id end as shop_id,
              s.sell_date, {TS_NOW} as created_at
       from v_sell s where {rng('s.sell_date', P.RANGE_START, P.RANGE_END)}""",
    BASE_CTES,
)
def q_load_sell(spark, sf):
    t = full(spark, sf)
    return conform(L.load_sell(dom(spark, sf).v_sell, P.RANGE_START, P.RANGE_END, active_shops(t)), S.SELL, P.NOW)


@register(
    "load_sell_detail",
    f"""select d.id, d.sell_id,
              case when d.company_id in (select id from t_suppliers) then d.company_id end as company_id,
              case when d.product_id in (select id from t_limited) then d.product_id end as product_id,
              case when d.shop_id in (select id from t_active) then d.shop_id end as shop_id,
              coalesce(d.qty, 0) as qty, s.sell_date, {TS_NOW} as created_at
       from v_sell_detail d join v_sell s on d.sell_id = s.id
       where {rng('s.sell_date', P.RANGE_START, P.RANGE_END)}""",
    BASE_CTES,
)
def q_load_sell_detail(spark, sf):
    t = full(spark, sf)
    d = dom(spark, sf)
    return conform(
        L.load_sell_detail(d.v_sell_detail, d.v_sell, P.RANGE_START, P.RANGE_END, active_shops(t),
                           limited_products(t), t.suppliers),
        S.SELL_DETAIL, P.NOW,
    )


@register(
    "append_embedding",
    f"""select vec_id as id, label as product_id, 'embedding ' || cast(vec_id as varchar) as content,
              len(embedding) as n_dims, {TS_NOW} as created_at
       from embeddings where embedding is not null""",
)
def q_append_embedding(spark, sf):
    from ..operators.similar import append_embedding, save_embeddings

    ensure_scratch(spark)
    path = scratch_path(spark, "queries", "product_embeddings")
    rows = append_embedding(dom(spark, sf).embeddings, P.NOW)
    for half in (0, 1):  # two calls of the insert
        save_embeddings(rows.where(F.col("id") % 2 == half), path)
    out = spark.read.parquet(path)
    return out.select("id", "product_id", "content", F.size("embedding").alias("n_dims"), "created_at")
