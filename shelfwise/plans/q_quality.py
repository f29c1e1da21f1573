"""Registered queries: data-quality checks, dead letters, reconciliation, audit, idempotence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import constraints as C
from ..operators import digest as DG
from ..operators import keys as K
from ..operators import quality as Q
from ..operators.upsert import read_snapshot
from ..session import scratch_path
from . import loads as L
from . import params as P
from .catalog import register
from .q_load import (
    BASE_CTES, SELL_NEW, SELL_OLD, STOCK_CTES, UPSERT_SELL_SQL, active_shops, dom, full, limited_products, ranged, rng, stored, stored_fact,
)

# Declared NOT NULL columns checked on the loaded targets (plus the source detail keys).
NOT_NULL = {
    "products": ["description"],
    "sell_detail": ["sell_id", "qty", "sell_date", "product_id", "shop_id"],
}
EVENT_TYPES = ("click", "view", "purchase", "signup")  # fixed allowed list of the check
DESCRIPTION_BOUND = 11  # sample VARCHAR(11) label bound for the product description

RESTRICTED_DETAIL = f"""
    select d.id, d.sell_id,
           case when d.company_id in (select id from t_suppliers) then d.company_id end as company_id,
           case when d.product_id in (select id from t_limited) then d.product_id end as product_id,
           case when d.shop_id in (select id from t_active) then d.shop_id end as shop_id,
           coalesce(d.qty, 0) as qty, s.sell_date
    from v_sell_detail d join v_sell s on d.sell_id = s.id
    where {rng('s.sell_date', P.FULL_START, P.FULL_END)}"""
Q_CTES = {**BASE_CTES, "t_rdetail": RESTRICTED_DETAIL}


def _restricted_detail(spark, sf):
    t = full(spark, sf)
    d = dom(spark, sf)
    return L.load_sell_detail(d.v_sell_detail, d.v_sell, P.FULL_START, P.FULL_END, active_shops(t),
                              limited_products(t), t.suppliers)


@register(
    "dq_not_null",
    "select 'products' as table_name, 'description' as column_name, "
    "count(*) filter (where description is null) as n_null from t_products "
    + "".join(
        f"union all select 'sell_detail', '{c}', count(*) filter (where {c} is null) from t_rdetail "
        for c in NOT_NULL["sell_detail"]
    ),
    Q_CTES,
)
def q_dq_not_null(spark, sf):
    t = full(spark, sf)
    return Q.dq_not_null(t.products, "products", NOT_NULL["products"]).unionByName(
        Q.dq_not_null(_restricted_detail(spark, sf), "sell_detail", NOT_NULL["sell_detail"])
    )


@register(
    "dq_in_set",
    "select event_id, 'event_type' as column_name, event_type as value from events "
    f"where event_type not in {tuple(EVENT_TYPES)}",
)
def q_dq_in_set(spark, sf):
    return Q.dq_in_set(dom(spark, sf).events, "event_id", "event_type", EVENT_TYPES)


@register("dq_compare", "select id, show_qty, max_qty from v_setting where not (show_qty <= max_qty)")
def q_dq_compare(spark, sf):
    return Q.dq_compare(dom(spark, sf).v_setting, "id", "show_qty", "max_qty")


@register(
    "dq_foreign_key",
    """select 'product_id' as fk_column, cast(product_id as bigint) as key_value, count(*) as n_rows
       from v_sell_detail where product_id is not null and product_id not in (select id from t_limited) group by all
       union all
       select 'shop_id', cast(shop_id as bigint), count(*)
       from v_sell_detail where shop_id is not null and shop_id not in (select id from t_active) group by all""",
    BASE_CTES,
)
def q_dq_foreign_key(spark, sf):
    t = full(spark, sf)
    return Q.dq_foreign_key(
        dom(spark, sf).v_sell_detail, {"product_id": limited_products(t), "shop_id": active_shops(t)}
    )


@register(
    "dq_unique",
    "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by all having count(*) > 1",
)
def q_dq_unique(spark, sf):
    return Q.dq_unique(dom(spark, sf).table("lineitem"), ["l_orderkey", "l_linenumber"])


@register(
    "dq_length",
    f"""select id, 'description' as column_name, length(description) as length, {DESCRIPTION_BOUND} as bound
        from v_product where length(description) > {DESCRIPTION_BOUND}
        union all
        select id, 'name', length(name), 255 from v_company where length(name) > 255""",
)
def q_dq_length(spark, sf):
    d = dom(spark, sf)
    return Q.dq_length(d.v_product, "id", {"description": DESCRIPTION_BOUND}).unionByName(
        Q.dq_length(d.v_company, "id", {"name": 255})
    )


#: Products whose id has these remainders lose their description, get a long code, or are doubled, for the checks to find.
BROKEN, NO_TEXT, LONG_CODE, TWICE = 97, 3, 5, 7


def _broken_products(p: DataFrame) -> DataFrame:
    rest = F.pmod(F.col("id"), F.lit(BROKEN))
    copies = F.when(rest == TWICE, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    p = p.withColumns({
        "description": F.when(rest != NO_TEXT, F.col("description")),
        "pu_product_id": F.when(rest == LONG_CODE, F.lpad("pu_product_id", 51, "0")).otherwise(F.col("pu_product_id")),
    })
    return p.withColumn("_t", F.explode(copies)).drop("_t")


def _named_table(id_col: str, label: str, text: str) -> str:
    return f"select distinct {id_col} as id, {text} as {label}, 'ACTIVE' as status from v_product"


# The tables as the declared rules are checked on them, and the parents: only active shops, groups up to
# MAX_VALID_GROUP and their products are known, so that foreign keys have something to miss.
DECLARED = {
    "branches": "select * from t_branches",
    "product_brands": _named_table("brand_id", "name", "brand_name"),
    "product_categories": _named_table("category_id", "name", "category_name"),
    "product_groups": _named_table("group_id", "description", "'SIZE ' || cast(group_id as varchar)"),
    "product_types": _named_table("type_id", "name", "type_name"),
    "products": f"""
        select id, case when id % {BROKEN} = {LONG_CODE} then lpad(pu_product_id, 51, '0') else pu_product_id end as pu_product_id,
               brand_id, category_id, group_id, type_id, case when id % {BROKEN} <> {NO_TEXT} then description end as description, status
        from t_products, (select unnest([1, 2]) as k) where k = 1 or id % {BROKEN} = {TWICE}""",
    "suppliers": "select * from t_suppliers",
    "customers": """select id, coalesce(code, '') as code, coalesce(name, '') as name, coalesce(tax_id, '') as tax_id,
           coalesce(nationid, '') as nation_id, coalesce(address, '') as address, coalesce(tel, '') as tel,
           coalesce(email1, '') as email, 'ACTIVE' as status from v_company where type = 'C'""",
    "sell": "select * from v_sell",
    "sell_detail": "select d.*, s.sell_date from v_sell_detail d join v_sell s on d.sell_id = s.id",
    "stock_balance": f"select *, '{S.PO_STATUS_DEFAULT}' as po_status from t_stock",
    "stock_targets": "select * from t_setting_latest",
    "product_embeddings": "select vec_id as id, label as product_id, 'vector' as content from embeddings",
}
PARENTS = {
    "branches": "t_active",
    "suppliers": "t_suppliers",
    "products": "t_limited",
    "product_groups": f"(select distinct group_id as id from v_product where group_id <= {P.MAX_VALID_GROUP})",
    **{t: f"(select distinct {c} as id from v_product)" for t, c in (("product_brands", "brand_id"), ("product_categories", "category_id"), ("product_types", "type_id"))},
}


def _declared_sql() -> str:
    parts = []
    for table in DECLARED:
        rules = S.CONSTRAINTS[table]
        checks = [("not_null", c, f"{c} is null") for c in rules.not_null]
        checks += [("length", c, f"length({c}) > {n}") for c, n in rules.lengths.items()]
        checks += [("foreign_key", c, f"{c} is not null and {c} not in (select id from {PARENTS[p]})") for c, p in rules.references.items()]
        parts += [f"select '{table}' as table_name, '{rule}' as rule, '{c}' as column_name, count(*) filter (where {bad}) as n_rows from d_{table}" for rule, c, bad in checks]
        keys = ", ".join(S.TARGETS[table].keys)
        parts.append(f"select '{table}', 'unique', '{keys.replace(' ', '')}', count(*) from (select {keys} from d_{table} group by all having count(*) > 1)")
    return " union all ".join(parts)


@register("dq_constraints", _declared_sql(), {**STOCK_CTES, **{f"d_{t}": sql for t, sql in DECLARED.items()}})
def q_dq_constraints(spark, sf):
    """Every declared NOT NULL, bound, foreign key (16) and key of the 13 targets, with the rows that fail."""
    t = full(spark, sf)
    d = dom(spark, sf)
    tables = {
        "branches": t.branches, "product_brands": t.brands, "product_categories": t.categories, "product_groups": t.groups,
        "product_types": t.types, "products": _broken_products(t.products), "suppliers": t.suppliers, "customers": t.customers,
        "sell": d.v_sell, "sell_detail": L.join_detail_header(d.v_sell_detail, d.v_sell, None, None),
        "stock_balance": t.stock_balance, "stock_targets": t.stock_targets,
        "product_embeddings": d.embeddings.select(F.col("vec_id").alias("id"), F.col("label").alias("product_id"), F.lit("vector").alias("content")),
    }
    parents = {
        "branches": active_shops(t), "suppliers": t.suppliers, "products": limited_products(t), "product_brands": t.brands,
        "product_categories": t.categories, "product_types": t.types, "product_groups": t.groups.where(F.col("id") <= P.MAX_VALID_GROUP),
    }
    return reduce(DataFrame.unionByName, [C.report(df, name, parents) for name, df in tables.items()])


@register(
    "dlq",
    """select 'stock_shop' as source_table, cast(shop_id as varchar) || ':' || cast(product_id as varchar) as row_key,
              fk_reason as reason,
              to_json(struct_pack(shop_id := shop_id, product_id := product_id, qty := qty)) as payload
       from (select shop_id, product_id, qty,
                    nullif(concat_ws(',',
                       case when not (shop_id > 0 and shop_id in (select id from t_active)) or shop_id is null
                            then 'unknown_shop_id' end,
                       case when not (product_id > 0 and product_id in (select id from t_limited)) or product_id is null
                            then 'unknown_product_id' end), '') as fk_reason
             from v_stock_shop)
       where fk_reason is not null""",
    BASE_CTES,
)
def q_dlq(spark, sf):
    t = full(spark, sf)
    rej = K.fk_reject(dom(spark, sf).v_stock_shop, {"shop_id": active_shops(t), "product_id": limited_products(t)})
    return Q.dlq(rej, "stock_shop", ["shop_id", "product_id"])


def _recon_sql(src: str, tgt: str, measure: str) -> str:
    return f"""
        select 'sell' as table_name, coalesce(s.day, t.day) as day,
               cast(coalesce(s.v, 0) as bigint) as source_value, cast(coalesce(t.v, 0) as bigint) as target_value,
               cast(coalesce(s.v, 0) as bigint) - cast(coalesce(t.v, 0) as bigint) as diff
        from (select cast(cast(sell_date as date) as timestamp) as day, {measure} as v from {src} group by all) s
        full join (select cast(cast(sell_date as date) as timestamp) as day, {measure} as v from {tgt} group by all) t
          on s.day = t.day"""


RANGE_SELL = f"select * from v_sell where {rng('sell_date', P.RANGE_START, P.RANGE_END)}"
SRC_DETAIL = "select d.qty, s.sell_date from v_sell_detail d join v_sell s on d.sell_id = s.id"
RANGE_DETAIL = f"select * from t_src_detail where {rng('sell_date', P.RANGE_START, P.RANGE_END)}"


@register(
    "reconcile_counts",
    _recon_sql("v_sell", "t_range_sell", "count(*)"),
    {"t_range_sell": RANGE_SELL},
)
def q_reconcile_counts(spark, sf):
    return Q.reconcile(dom(spark, sf).v_sell, spark.read.parquet(f"{ranged(spark, sf)}/sell"), "sell")


@register(
    "reconcile_sums",
    _recon_sql("t_src_detail", "t_range_detail", "sum(qty)").replace("'sell' as table_name", "'sell_detail' as table_name"),
    {"t_src_detail": SRC_DETAIL, "t_range_detail": RANGE_DETAIL},
)
def q_reconcile_sums(spark, sf):
    d = dom(spark, sf)
    src = L.join_detail_header(d.v_sell_detail, d.v_sell, P.FULL_START, P.FULL_END)
    return Q.reconcile(src, spark.read.parquet(f"{ranged(spark, sf)}/sell_detail"), "sell_detail", measure="qty")


#: Ids divided by DAMAGE with these remainders are lost, changed or doubled in the copy that reconcile_rows finds.
DAMAGE, LOST, CHANGED, DOUBLED = 499, 3, 5, 7


def _damaged(df: DataFrame, key: Column, column: str) -> DataFrame:
    rest = F.pmod(key, F.lit(DAMAGE))
    times = F.when(rest == DOUBLED, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    wrong = F.when(rest == CHANGED, F.coalesce(F.col(column), F.lit(0)) + 1000).otherwise(F.col(column))
    return df.where(rest != LOST).withColumn(column, wrong.cast(df.schema[column].dataType)).withColumn("_t", F.explode(times)).drop("_t")


def _damage_sql(table: str, key: str, source: str, number: str) -> str:
    return f"""
        select '{table}' as table_name, {key} as row_key,
               case {number} % {DAMAGE} when {LOST} then 'lost' when {CHANGED} then 'changed' else 'doubled' end as state,
               cast(1 as bigint) as n_source, cast(case {number} % {DAMAGE} when {LOST} then 0 when {CHANGED} then 1 else 2 end as bigint) as n_target
        from {source} where {number} % {DAMAGE} in ({LOST}, {CHANGED}, {DOUBLED})"""


@register(
    "reconcile_rows",
    _damage_sql("sell", "cast(id as varchar)", "v_sell", "id")
    + " union all "
    + _damage_sql("stock_balance", "cast(shop_id as varchar) || ':' || cast(product_id as varchar)", "t_stock", "(product_id * 31 + shop_id)"),
    STOCK_CTES,
)
def q_reconcile_rows(spark, sf):
    """Written targets, one damaged on purpose, against the source: digests by month and day, or hash range, then rows."""
    t = full(spark, sf)
    d = dom(spark, sf)
    sell = stored_fact(spark, sf, S.SELL)
    root = scratch_path(spark, "queries", "damaged")
    _damaged(sell, F.col("id"), "shop_id").write.partitionBy("sell_month").parquet(f"{root}/sell")
    stock = read_snapshot(spark, f"{stored(spark, sf).root}/stock_balance", S.STOCK_BALANCE)
    _damaged(stock, F.col("product_id") * 31 + F.col("shop_id"), "qty").write.parquet(f"{root}/stock")
    bills = L.load_sell(d.v_sell, P.FULL_START, P.FULL_END, t.branches)
    lost = DG.descend(bills, spark.read.parquet(f"{root}/sell"), ["id"], ["id", "shop_id", "sell_date"], DG.month_levels("sell_date"))
    balance = L.load_stock_balance(d.v_stock_shop, t.branches, t.products).withColumn("qty", F.col("qty").cast("int"))
    keys = ["shop_id", "product_id"]
    odd = DG.descend(balance, spark.read.parquet(f"{root}/stock"), keys, [*keys, "qty"], DG.hash_levels(keys))
    return lost.select(F.lit("sell").alias("table_name"), F.col("id").cast("string").alias("row_key"), "state", "n_source", "n_target").unionByName(
        odd.select(F.lit("stock_balance").alias("table_name"), F.concat_ws(":", *keys).alias("row_key"), "state", "n_source", "n_target")
    )


AUDIT_SEED = "2026"


@register(
    "audit_sample",
    f"""select s.id, t.id is not null and (s.shop_id is not distinct from t.shop_id) as shop_id_match,
              t.id is not null and (s.sell_date is not distinct from t.sell_date) as sell_date_match,
              t.id is not null as found
       from (select id, shop_id, sell_date from v_sell
             order by md5(cast(id as varchar) || '|{AUDIT_SEED}') limit 100) s
       left join t_upserted t on s.id = t.id""",
    {**BASE_CTES, "sell_old": SELL_OLD, "sell_new": SELL_NEW, "t_upserted": UPSERT_SELL_SQL},
)
def q_audit_sample(spark, sf):
    from .q_load import q_upsert_sells

    target = q_upsert_sells(spark, sf)
    return Q.audit_sample(dom(spark, sf).v_sell, target, "id", ["shop_id", "sell_date"], 100, AUDIT_SEED)


STRATUM = 4  # rows of each shop: 100 bills and 100 stocks of 25 shops


def _strata_sql(table: str, key: str, source: str, target: str, on: str, same: str) -> str:
    return f"""
        select '{table}' as table_name, s.row_key, s.shop_id, t.row_key is not null and {same} as same, t.row_key is not null as found
        from (select *, {key} as row_key from {source}
              qualify row_number() over (partition by shop_id order by md5({key} || '|{AUDIT_SEED}'), {key}) <= {STRATUM}) s
        left join (select *, {key} as row_key from {target}) t on {on}"""


@register(
    "audit_strata",
    _strata_sql("sell", "cast(id as varchar)", "v_sell", "t_range_sell", "s.row_key = t.row_key", "s.sell_date is not distinct from t.sell_date")
    + " union all "
    + _strata_sql("stock_balance", "cast(shop_id as varchar) || ':' || cast(product_id as varchar)", "t_stock", "(select * from t_stock where product_id % 3 <> 0)",
                  "s.row_key = t.row_key", "s.qty is not distinct from t.qty"),
    {**STOCK_CTES, "t_range_sell": RANGE_SELL},
)
def q_audit_strata(spark, sf):
    """Bills and stocks of every shop against written targets: a load of a window, and a balance that lacks some products."""
    d = dom(spark, sf)
    t = full(spark, sf)
    sell = spark.read.parquet(f"{ranged(spark, sf)}/sell")
    bills = Q.audit_strata(d.v_sell, sell, "sell", ["id"], ["shop_id"], ["sell_date"], STRATUM, AUDIT_SEED)
    stock = read_snapshot(spark, f"{stored(spark, sf).root}/stock_balance", S.STOCK_BALANCE).where("product_id % 3 <> 0")
    balance = L.load_stock_balance(d.v_stock_shop, t.branches, t.products)
    return bills.unionByName(Q.audit_strata(balance, stock, "stock_balance", ["shop_id", "product_id"], ["shop_id"], ["qty"], STRATUM, AUDIT_SEED))
